"""Staging models and marts on hand-written payloads, against hand-written rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitchflow import plans
from pitchflow.bindings import derived

AT = dt.datetime(2025, 8, 1, 12, 0, 0)
LATER = dt.datetime(2025, 8, 2, 12, 0, 0)


def raw(spark, rows, extra=""):
    """RAW rows (ingested_at, league_id, season, *extra, payload); payloads as text."""
    schema = "ingested_at timestamp_ntz, league_id long, season int" + (f", {extra}" if extra else "") + ", payload string"
    return spark.createDataFrame([(*r[:-1], r[-1] if r[-1] is None or isinstance(r[-1], str) else json.dumps(r[-1])) for r in rows], schema)


def only(df):
    got = df.collect()
    assert len(got) == 1
    return got[0].asDict()


def as_json(df, *names):
    for n in names:
        df = df.withColumn(n, F.to_json(n))
    return df


@pytest.fixture(params=["text", "variant"])
def kind(request):
    return request.param


def typed(df, kind):
    return df if kind == "text" else df.withColumn("payload", F.try_parse_json("payload"))


def test_league(spark, kind):
    item = {"league": {"id": 1, "name": " Alpha ", "type": "League", "logo": "l"}, "country": {"name": "X", "code": "XL", "flag": "f"}}
    df = plans.stg_league(typed(raw(spark, [(AT, 1, 2025, item), (AT, 2, 2025, "broken"), (AT, 3, 2025, None)]), kind))
    got = {r.league_id: r for r in df.collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].league_id_from_payload, got[1].league_name, got[1].country_code) == (1, " Alpha ", "XL")
    assert got[2].league_name is None and got[2].payload is None


def test_teams_info(spark, kind):
    item = {
        "team": {"id": 10, "name": "Reds", "code": "RED", "country": "X", "founded": 1900, "national": "true", "logo": "t"},
        "venue": {"id": 5, "name": "Park", "address": "1 St", "city": "Y", "capacity": "40000", "surface": "grass", "image": "v"},
    }
    rows = [(AT, 1, 2025, 10, item), (AT, 1, 2025, 11, "broken"), (AT, 1, 2025, 12, None)]
    got = only(plans.stg_teams_info(typed(raw(spark, rows, "team_id long"), kind)).drop("payload_json"))
    assert got["api_team_id"] == 10 and got["is_national_team"] is True and got["venue_capacity"] == 40000


def test_team_statistics_round_and_survive_bad_averages(spark, kind):
    item = {
        "team": {"id": 10, "name": "Reds", "logo": "u"},
        "form": "WDL",
        "fixtures": {"played": {"total": 38}, "wins": {"total": 20}, "draws": {"total": 10}, "loses": {"total": 8}},
        "goals": {
            "for": {"total": {"total": 60}, "average": {"total": "1.6"}},
            "against": {"total": {"total": 40}, "average": {"total": "n/a"}},
        },
        "clean_sheet": {"total": 12},
        "failed_to_score": {"total": 6},
        "penalty": {"scored": {"total": 4}, "missed": {"total": 1}},
    }
    got = only(plans.stg_team_statistics(typed(raw(spark, [(AT, 1, 2025, item)]), kind)).drop("payload_json"))
    assert (got["goals_for_avg_total"], got["goals_against_avg_total"]) == (2, None)
    assert (got["fixtures_loses_total"], got["penalty_missed_total"], got["form"]) == (8, 1, "WDL")


def test_players_statistics(spark, kind):
    item = {
        "player": {"id": 7, "firstname": "José", "lastname": "Núñez", "age": 25, "nationality": "X", "photo": "https:p"},
        "statistics": [{"team": {"id": 10}, "games": {"n": 1}, "goals": None}, {"team": {"id": 11}}],
    }
    df = plans.stg_players_statistics(typed(raw(spark, [(AT, 1, 2025, item), (AT, 1, 2025, "")]), kind))
    got = only(as_json(df, *[c for c in df.columns if c.endswith("_json")]))
    assert (got["team_id"], got["player_id"], got["player_age"]) == (10, 7, 25)
    # a JSON null is a value, a missing section is not
    assert (got["games_json"], got["goals_json"], got["passes_json"]) == ('{"n":1}', "null", None)
    assert len(df.columns) == 23


def trophies(n, tag):
    return [{"league": f"{tag}{i}", "season": str(2000 + i), "place": "Winner"} for i in range(n)]


def test_player_trophies_both_shapes_and_limit(spark, kind):
    rows = [
        (AT, 1, 2025, {"id": 7, "trophies": trophies(25, "a")}),
        (LATER, 2, 2025, {"team_id": 3, "response": [{"id": 7, "trophies": trophies(2, "b")}, {"id": 8, "trophies": trophies(1, "c")}]}),
        (AT, 1, 2025, {"id": 9, "trophies": []}),
        (AT, 1, 2025, {"id": 10}),
        (AT, 1, 2025, "broken"),
    ]
    df = plans.stg_player_trophies(typed(raw(spark, rows), kind))
    got = {r.player_id: r.asDict() for r in as_json(df, "payload_json").collect()}
    assert set(got) == {7, 8}
    # list positions interleave: first entries of both ingests, oldest ingest first, then second entries
    assert [got[7][f"trophy_{i}_league"] for i in (1, 2, 3)] == ["a0", "b0", "a1"]
    assert got[7]["league_id"] == 2 and '"league":"b0"' in got[7]["payload_json"]
    assert got[8]["trophy_1_league"] == "c0" and got[8]["trophy_2_league"] is None and got[8]["league_id"] == 2


FIXTURE = {
    "fixture": {
        "id": 100,
        "date": "2025-08-16T14:00:00+07:00",
        "timestamp": 1755352800,
        "timezone": "UTC",
        "referee": None,
        "periods": {"first": 1755352800, "second": 1755356400},
        "status": {"elapsed": 90, "extra": 4, "long": "Match Finished", "short": "FT"},
        "venue": {"id": 5, "name": "Park", "city": "Xtown"},
    },
    "goals": {"home": 2, "away": 1},
    "league": {"id": 1, "name": "Alpha", "country": "X", "season": 2025, "round": "R1", "standings": True, "logo": "u", "flag": "u"},
    "teams": {
        "home": {"id": 10, "name": "Reds", "logo": "u", "winner": True},
        "away": {"id": 11, "name": " Blues ", "logo": "u", "winner": False},
    },
    "score": {"halftime": {"home": 1, "away": 0}, "fulltime": {"home": 2, "away": 1}, "extratime": {"home": None, "away": None}},
}


def fixtures(spark, *rows):
    return plans.stg_fixture_info(raw(spark, rows, "fixture_id long"))


def test_fixture_info(spark, kind):
    df = plans.stg_fixture_info(typed(raw(spark, [(AT, 1, 2025, 100, FIXTURE), (AT, 1, 2025, 101, None)], "fixture_id long"), kind))
    got = only(df.withColumn("fixture_date_utc", F.col("fixture_date_utc").cast("string")).drop("payload_response"))
    assert got["fixture_date_utc"] == "2025-08-16 07:00:00"
    assert (got["status_extra"], got["score_et_home"], got["score_p_away"]) == (4, None, None)
    assert (got["home_team_winner"], got["away_team_winner"], got["league_standings"]) == (True, False, True)
    assert len(df.columns) == 45


def test_fixture_info_strict_number(spark):
    bad = {**FIXTURE, "goals": {"home": "two", "away": 1}}
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        fixtures(spark, (AT, 1, 2025, 100, bad)).collect()


def test_line_up(spark, kind):
    item = {"team": {"id": 10, "name": "R", "logo": "u", "colors": {}}, "coach": {"id": 3, "name": "C", "photo": "p"}, "formation": "4-3-3", "startXI": [{}] * 11, "substitutes": None}
    df = plans.stg_fixture_line_up(typed(raw(spark, [(AT, 1, 2025, 100, item)], "fixture_id long"), kind))
    got = only(as_json(df, "team_colors", "start_xi_json", "substitutes_json"))
    assert (got["start_xi_cnt"], got["substitutes_cnt"], got["substitutes_json"], got["team_colors"]) == (11, None, "null", "{}")


def test_fixture_statistics(spark, kind):
    def item(*stats):
        return {"team": {"id": 10, "name": "R", "logo": "u"}, "statistics": [{"type": t, "value": v} for t, v in stats]}

    rows = [
        (AT, 1, 2025, 100, item(("Shots on Goal", 5), ("Shots on Goal", "7"), ("Ball Possession", "55%"), ("Passes %", "x"), ("Red Cards", None), ("Offsides", "1.7"), ("xG", "9"))),
        (AT, 1, 2025, 100, item(("Fouls", 3))),
        (LATER, 1, 2025, 100, item(("Fouls", 4))),
        (AT, 1, 2025, 101, item()),
        (AT, 1, 2025, 102, {"team": {"id": 1}}),
    ]
    df = plans.stg_fixture_statistics(typed(raw(spark, rows, "fixture_id long"), kind))
    got = {r.ingested_at: r for r in df.collect()}
    assert set(got) == {AT, LATER} and df.count() == 2
    first = got[AT]
    assert (first.shots_on_goal, first.ball_possession_pct, first.passes_pct, first.red_cards, first.offsides, first.fouls) == (7, 55, None, None, 2, 3)
    assert len(df.columns) == 23


def test_fixture_players(spark, kind):
    item = {
        "team": {"id": 10, "name": "R"},
        "players": [
            {"player": {"id": 7, "name": "N", "photo": "p"}, "statistics": [{"cards": {"y": 1}, "offsides": "2"}, {"offsides": "x"}]},
            {"player": {"id": 8}, "statistics": []},
            {"player": {"id": 9}, "statistics": [None]},
        ],
    }
    df = plans.stg_fixture_players_statistics(typed(raw(spark, [(AT, 1, 2025, 100, item)], "fixture_id long"), kind))
    got = sorted((r.player_id, r.offsides, r.cards_json) for r in as_json(df, "cards_json").collect() if r.player_id == 7 and r.cards_json)
    assert got == [(7, 2, '{"y":1}')]
    assert sorted(r.player_id for r in df.collect()) == [7, 7, 9]


def test_fixture_players_is_read_once(spark):
    df = plans.stg_fixture_statistics(raw(spark, [(AT, 1, 2025, 100, FIXTURE)], "fixture_id long"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("$.team.name") == 1


def test_predictions(spark, kind):
    item = {
        "predictions": {"advice": "Home", "percent": {"home": "45%", "draw": "45%", "away": "10.5%"}},
        "teams": {"home": {"id": 10, "name": "R", "last_5": {"a": 1}, "league": {}}, "away": {"id": 11, "name": "B"}},
    }
    df = plans.stg_fixture_predictions(typed(raw(spark, [(AT, 1, 2025, 100, item)], "fixture_id long"), kind))
    got = only(as_json(df.drop("payload_json"), "team_home_last_5", "team_away_last_5", "team_home_league", "team_away_league"))
    assert (got["percent_home"], got["percent_away"], got["team_home_last_5"], got["team_away_last_5"]) == (45, 11, '{"a":1}', None)


def test_football_manager_names_with_and_without_mark(spark):
    rows = [(AT, '{"\\ufeffName":"A","Nationality":"X"}'), (AT, '{"Name":"B"}'), (AT, None)]
    df = spark.createDataFrame(rows, "ingested_at timestamp_ntz, payload string")
    got = sorted((r.player_name, r.nationality) for r in plans.stg_football_manager(df).collect())
    assert got == [("A", "X"), ("B", None)]


def live(spark, *rows):
    schema = "ingested_at timestamp_ntz, topic string, partition int, offset long, message_key string, kafka_timestamp timestamp_ntz, message_value string"
    return spark.createDataFrame(rows, schema)


def message(minute=23, kind="Card", detail="Yellow Card", at="2025-08-16T14:23:00+07:00", **event):
    body = {"time": {"elapsed": minute, "extra": None}, "type": kind, "detail": detail, "team": {"id": 10, "name": "R", "logo": "u"}, "player": {"id": 7, "name": "N"}, "assist": {"id": 8, "name": "M"}}
    return json.dumps({"ingested_at_utc": at, "fixture_id": 100, "event": {**body, **event}})


def test_live_events_and_facts(spark):
    t1, t2 = dt.datetime(2025, 8, 16, 1), dt.datetime(2025, 8, 16, 2)
    raw_rows = live(
        spark,
        (t1, "t", 0, 1, "100", t2, message()),
        (t1, "t", 0, 2, "100", None, message(kind="GOAL", detail="Normal Goal")),
        (t1, "t", 0, 3, "100", None, message(kind="subst", at=None)),
        (t1, "t", 0, 4, "100", t2, message(kind="Substitution")),
        (t1, "t", 0, 5, "100", t2, message(kind="cArD", detail="Second yellow, RED")),
        (t1, "t", 0, 6, "100", t2, message(kind="card", detail="Foul")),
        (t1, "t", 0, 7, "100", t2, "<broken"),
        (t1, "t", 0, 8, "100", t2, None),
    )
    for source in (raw_rows, raw_rows.withColumn("message_value", F.try_parse_json("message_value"))):
        fact = plans.fct_fixture_live_event(plans.stg_kafka_fixture_live_events(source))
        by_id = {r.event_id: r for r in fact.collect()}
        assert sorted(by_id) == [f"t:0:{i}" for i in range(1, 7)]
        # log time, else message time with its zone ignored, else load time
        assert by_id["t:0:1"].event_time == t2
        assert by_id["t:0:2"].event_time == dt.datetime(2025, 8, 16, 14, 23)
        assert by_id["t:0:3"].event_time == t1
        cards = {r.event_id: r.card_color for r in plans.fct_fixture_live_card(fact).collect()}
        assert cards == {"t:0:1": "yellow", "t:0:5": "red", "t:0:6": "unknown"}
        goal = only(plans.fct_fixture_live_goal(fact))
        assert (goal["scorer_id"], goal["scorer_name"], goal["assist_id"]) == (7, "N", 8)
        subs = plans.fct_fixture_live_substitution(fact).collect()
        assert sorted(r.event_id for r in subs) == ["t:0:3", "t:0:4"]
        assert (subs[0].player_out_id, subs[0].player_in_id) == (7, 8)


def test_live_value_holding_json_text_is_parsed_again(spark):
    text = live(spark, (AT, "t", 0, 1, "100", None, json.dumps(message()))).withColumn("message_value", F.parse_json("message_value"))
    assert only(plans.stg_kafka_fixture_live_events(text).drop("message_value_json"))["fixture_id"] == 100


def test_dims(spark):
    as_of = F.lit("2025-09-01 00:00:00").cast("timestamp")
    stg = fixtures(spark, (AT, 1, 2024, 100, FIXTURE), (LATER, 2, 2025, 100, FIXTURE), (None, 3, 2023, 101, FIXTURE), (LATER, 4, 2025, 101, FIXTURE))
    got = {r.fixture_id: (r.league_id, r.season) for r in plans.dim_fixture(stg, as_of).collect()}
    assert got == {100: (2, 2025), 101: (3, 2023)}
    stamped = plans.dim_fixture(stg, as_of).select(F.col("created_at").cast("string"), F.col("updated_at").cast("string")).first()
    assert tuple(stamped) == ("2025-09-01 00:00:00",) * 2

    info = plans.stg_teams_info(raw(spark, [(LATER, 9, 2025, 10, {"team": {"name": "  "}}), (AT, 9, 2025, 12, {"team": {"name": " Greens "}})], "team_id long"))
    one = fixtures(spark, (AT, 1, 2025, 100, FIXTURE))
    got = {r.team_id: (r.team_name, r.league_id) for r in plans.dim_team(info, one).collect()}
    assert got == {10: (None, 9), 11: ("Blues", 1), 12: ("Greens", 9)}


def test_dim_league(spark):
    def item(name, country):
        return {"league": {"name": name}, "country": {"name": country}}

    rows = [(AT, 1, 2024, item("Old", "X")), (LATER, 1, 2025, item(" New ", " ")), (LATER, None, 2025, item("None", "X")), (None, 2, 2025, item("N", "Y")), (AT, 2, 2025, item("N", "Y"))]
    got = {r.league_id: (r.league_name, r.league_country) for r in plans.dim_league(plans.stg_league(raw(spark, rows))).collect()}
    assert got == {1: ("New", None), 2: ("N", "Y")}


def people(spark):
    def season(pid, first, last):
        return {"player": {"id": pid, "firstname": first, "lastname": last, "age": 25, "nationality": "X"}, "statistics": []}

    def match(*players):
        return {"team": {"id": 1}, "players": [{"player": {"id": i, "name": n}, "statistics": [{}]} for i, n in players]}

    stats = plans.stg_players_statistics(raw(spark, [(AT, 1, 2025, season(7, "José", "Núñez")), (LATER, 1, 2025, season(8, None, " ")), (AT, 1, 2025, season(None, "No", "Id"))]))
    played = plans.stg_fixture_players_statistics(raw(spark, [(LATER, 1, 2025, 100, match((7, " J. Núñez "), (9, "Only Match")))], "fixture_id long"))
    return plans.dim_player(stats, played)


def test_dim_player(spark):
    got = {r.player_id: (r.player_name, r.player_age, r.player_nationality) for r in people(spark).collect()}
    assert got == {7: ("J. Núñez", None, None), 8: (None, 25, "X"), 9: ("Only Match", None, None)}


def test_manager_match_and_audit(spark):
    schema = "ingested_at timestamp_ntz, payload string"
    rows = [
        (AT, '{"Name":"J NUNEZ","Nationality":"X"}'),
        (AT, '{"Name":"j. núñez!","Nationality":"old"}'),
        (LATER, '{"Name":" J  Nez","Nationality":"new"}'),
        (AT, '{"Name":"Nobody"}'),
        (AT, '{"Nationality":"nameless"}'),
    ]
    managers = plans.stg_football_manager(spark.createDataFrame(rows, schema))
    fact = plans.fct_football_manager(people(spark), managers)
    assert fact.columns == ["player_id", "dim_player_name", "ingested_at", "player_name", "nationality", "payload_json", "player_name_key", "rn"]
    # "J. Núñez" becomes "j nez": the two spellings without the accented letters match, the newest wins
    got = only(fact.drop("payload_json"))
    assert (got["player_id"], got["nationality"], got["player_name_key"], got["rn"]) == (7, "new", "j nez", 1)
    audit = plans.audit_manager_player_unmatched(managers, people(spark))
    assert sorted((r.player_name or "", r.nationality or "") for r in audit.collect()) == [("", "nameless"), ("J NUNEZ", "X"), ("Nobody", "")]


def test_results_do_not_depend_on_order_or_partitions(spark):
    from pitchflow.bindings import derived
    from pitchflow.bindings.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    managers = derived.source(t, "football_manager_raw")

    def run(parts, n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        part = t.part.repartition(parts)
        player = plans.dim_player(
            plans.stg_players_statistics(derived.raw_players_statistics(part)),
            plans.stg_fixture_players_statistics(derived.raw_fixture_players_statistic(t.orders.repartition(parts))),
        )
        fact = plans.fct_football_manager(player, plans.stg_football_manager(managers.repartition(parts)))
        trophies_ = plans.stg_player_trophies(derived.raw_player_trophies(part)).drop("payload_json")
        return sorted(map(str, fact.drop("payload_json").collect())), sorted(map(str, trophies_.collect()))

    try:
        assert run(1, 1) == run(7, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_groups(spark, tmp_path):
    from pitchflow.bindings import derived
    from pitchflow.bindings.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "tables")
    sources = derived.sources(t)
    history = plans.run_group(spark, "history", sources, root)
    assert set(history) == set(plans.GROUPS["history"]) and "stg_fixture_predictions" not in history
    n = history["dim_fixture"].count()
    kept = t.orders.filter("not (o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P')")
    assert n == kept.selectExpr("o_orderkey div 2").distinct().count()
    assert spark.table("dim_fixture").count() == n
    again = plans.run_group(spark, "history", sources, root)
    assert again["dim_fixture"].count() == n
    assert sorted(p.name for p in (tmp_path / "tables" / "dim_fixture").iterdir()) == ["version=00000001", "version=00000002"]

    half = {"kafka_fixture_live_events": sources["kafka_fixture_live_events"].filter("offset < 300")}
    assert plans.run_group(spark, "live", half, root)["fct_fixture_live_event"].count() == half["kafka_fixture_live_events"].filter("message_value like '{\"ing%'").count()
    whole = plans.run_group(spark, "live", sources, root)["fct_fixture_live_event"]
    assert whole.count() == whole.select("event_id").distinct().count() == t.events.filter("event_type <> 'view'").count()


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    plans.write_table(spark.range(3), path)
    (tmp_path / "t" / "version=00000002").mkdir()
    assert plans.current_table(spark, path).count() == 3
    assert plans.write_table(spark.range(5), path).endswith("version=00000003")
    assert plans.current_table(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        plans.current_table(spark, str(tmp_path / "none"))


def test_payloads_of_one_small_file_are_built_by_several_tasks(spark):
    n = 2 * derived.TASK_ROWS + 1
    part = spark.range(0, n, 1, 1).selectExpr(
        "id AS p_partkey", "'p' AS p_name", "'b' AS p_brand", "'LARGE' AS p_type", "cast(id % 30 + 1 AS int) AS p_size", "1.0D AS p_retailprice"
    )
    raw_ = derived.raw_player_trophies(part)
    assert raw_.rdd.getNumPartitions() == 3 and raw_.select("ingested_at").distinct().count() == n
    # a player's lists of up to 30 trophies: only the first 20 of a list are unfolded
    staged = plans.stg_player_trophies(derived.raw_player_trophies(part.limit(60)))
    assert "slice(" in staged._jdf.queryExecution().optimizedPlan().toString() and staged.count() == 30
    assert derived.raw_player_trophies(part.limit(0)).count() == 0


def test_live_events_of_one_small_file_are_built_by_several_tasks(spark):
    n = derived.TASK_ROWS + 1
    events = spark.range(0, n, 1, 1).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'click' AS event_type", "1.0D AS value", "'{}' AS props"
    )
    for made in (derived.kafka_fixture_live_events(events), derived.live_log(events)):
        assert made.rdd.getNumPartitions() == 2 and made.select("offset").distinct().count() == n
