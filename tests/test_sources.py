"""Envelopes, pages, tabular folders, RAW tables and the source registry."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from pitchflow import sources as S


def requests(spark, schema, *rows):
    return spark.createDataFrame([(*r[:-1], r[-1] if isinstance(r[-1], (str, type(None))) else json.dumps(r[-1])) for r in rows], f"{schema}, body string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_fixtures_endpoint(spark):
    body = {
        "response": [
            {"fixture": {"id": 100, "date": "2025-08-16"}, "teams": {"home": {"id": 1}, "away": None}},
            {"fixture": {"id": 0}},
            {"fixture": {}},
            {"fixture": {"id": 101}, "teams": {"home": {"id": 3}, "away": {"id": 4}}},
        ]
    }
    df = requests(spark, "league_id long, season int", (1, 2025, body), (2, 2025, {"response": None}), (3, 2025, {}), (4, 2025, "<html>"), (5, 2025, None))
    as_of = F.lit("2025-09-01 00:00:00").cast("timestamp")
    got = S.read_envelope(df, "fixtures", as_of=as_of)
    assert got.columns == ["league_id", "season", "fixture_id", "home_team_id", "away_team_id", "fixture_date", "pos", "extracted_at", "source", "payload"]
    assert rows(got.select("fixture_id", "home_team_id", "away_team_id", "fixture_date", "pos")) == [
        (100, 1, None, "2025-08-16", 0),
        (101, 3, 4, None, 3),
    ]
    assert rows(S.read_envelope(df, "fixtures", limit=3).select("fixture_id")) == [(100,)]


@pytest.mark.parametrize("endpoint", sorted(S.ENDPOINTS))
def test_every_endpoint_reads(spark, endpoint):
    spec = S.ENDPOINTS[endpoint]
    item = {"id": 5, "team": {"id": 6, "name": "R"}, "fixture": {"id": 7, "date": "d"}, "teams": {}, "players": [{"id": 8}, {"id": 0}]}
    body = {"response": item if spec.single else [item]}
    schema = ", ".join(f"{k} {'string' if k == 'side' else 'int' if k == 'season' else 'long'}" for k in spec.keys)
    keys = tuple("home" if k == "side" else 1 for k in spec.keys)
    got = S.read_envelope(requests(spark, schema, (*keys, body)), endpoint).collect()
    assert len(got) == 1
    if spec.required:
        assert got[0][spec.required] == {"team_id": 6, "player_id": 8, "fixture_id": 7}[spec.required]
    assert spec.raw in S.SOURCES


def test_squads_give_one_row_per_player(spark):
    body = {"response": [{"players": [{"id": 1, "name": "a"}, {"name": "no id"}, {"id": 2}]}, {"players": []}, {}]}
    got = S.read_envelope(requests(spark, "team_id long", (9, body)), "squads")
    assert rows(got.select("team_id", "player_id", F.to_json("payload"))) == [(9, 1, '{"id":1,"name":"a"}'), (9, 2, '{"id":2}')]


def test_team_statistics_with_errors_give_no_row(spark):
    df = requests(
        spark,
        "league_id long, season int, team_id long",
        (1, 2025, 10, {"response": {"form": "W"}, "errors": []}),
        (1, 2025, 11, {"response": {"form": "L"}, "errors": {"token": "x"}}),
        (1, 2025, 12, {"errors": []}),
    )
    assert rows(S.read_envelope(df, "team_statistics").select("team_id")) == [(10,)]
    assert rows(S.envelope_errors(df, "team_statistics").select("team_id", "error_key", "error")) == [(11, "token", "x")]


def test_errors(spark):
    df = requests(
        spark,
        "fixture_id long",
        (1, {"errors": ["a", "b"]}),
        (2, {"errors": [], "error": "single"}),
        (3, {"errors": {}, "error": []}),
        (4, {"errors": "text"}),
        (5, "nonsense"),
        (6, None),
        (7, {"errors": {"k1": "v1", "k2": 2}}),
    )
    got = rows(S.envelope_errors(df, "fixture_events"))
    failed = ("envelope", "missing or not JSON")
    assert got == [(1, 0, None, "a"), (1, 1, None, "b"), (2, 0, None, "single"), (4, 0, None, "text"), (5, 0, *failed), (6, 0, *failed), (7, 0, "k1", "v1"), (7, 1, "k2", "2")]


def test_trophy_batches_keep_their_batch(spark):
    df = requests(spark, "team_id long, batch_no long, ids string", (1, 1, "5-6", {"response": [{"id": 5}]}), (1, 2, "7", {"error": "quota"}))
    assert rows(S.envelope_errors(df, "trophies", carry=("batch_no", "ids"))) == [(2, "7", 1, 0, None, "quota")]
    assert rows(S.read_envelope(df, "trophies", carry=("batch_no",)).select("batch_no", F.to_json("payload"))) == [(1, '{"id":5}')]


def pages(spark, *specs):
    """(key, page, total, items) -> landed pages."""
    return requests(spark, "team_id long", *[(k, {"paging": {"current": p, "total": t}, "response": [f"{p}.{i}" for i in range(n)]}) for k, p, t, n in specs])


def test_merge_pages(spark):
    df = pages(
        spark,
        *[(1, p, 3, 2) for p in (1, 2, 3)],
        *[(2, p, 4, 1) for p in (1, 2, 4)],  # page 3 missing
        (3, 1, 3, 1), (3, 2, 3, 0), (3, 3, 3, 1),  # an empty page ends the list
        (4, 2, 2, 1),  # no first page
        (5, 1, 1, 2), (5, 1, 1, 2), (5, 2, 1, 9),  # first page landed twice, a page beyond the total
    )
    got = S.merge_pages(df, ["team_id"])
    counts = {r.team_id: r.n for r in got.groupBy("team_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {1: 6, 2: 2, 3: 1, 5: 2}
    assert [r[0] for r in got.filter("team_id = 1").orderBy("page", "pos").select(F.variant_get("payload", "$", "string")).collect()] == ["1.0", "1.1", "2.0", "2.1", "3.0", "3.1"]
    light = spark.createDataFrame([(1, 1, 2, 5), (1, 2, 2, 5), (2, 1, 3, 4), (2, 3, 3, 4), (3, 2, 2, 1)], "k int, page long, total long, n_items long")
    assert rows(S.page_status(light, ["k"])) == [(1, 2, 10, True), (2, 1, 4, False), (3, 0, 0, False)]


def test_landed_whole_files(spark, tmp_path):
    for i in (1, 2):
        folder = tmp_path / "landed" / f"d{i}"
        folder.mkdir(parents=True)
        body = {"parameters": {"fixture": str(i)}, "response": [{"n": i}]}
        (folder / f"r{i}.json").write_text(json.dumps(body, indent=2))
    landed = S.read_landed(spark, str(tmp_path / "landed"), {"fixture_id": "fixture"}, whole_files=True)
    got = S.read_envelope(landed, "fixture_events").select("fixture_id", F.to_json("payload"))
    assert rows(got) == [(1, '{"n":1}'), (2, '{"n":2}')]


def test_tabular_folders(spark, tmp_path):
    root = tmp_path / "dump"
    (root / "a" / "b").mkdir(parents=True)
    (root / "a" / "one.csv").write_text('\ufeffName,Nationality\n"Núñez, J.",X\nB,\n', encoding="utf-8")
    (root / "a" / "b" / "two.CSV").write_text('Name,Nationality\n"line\nbreak",Y\n', encoding="utf-8")
    (root / "notes.txt").write_text("skip me")
    got = S.read_csv_payload(spark, str(root)).select("source_file", F.to_json("payload"))
    assert rows(got) == [
        ("one.csv", '{"Name":"B","Nationality":null}'),
        ("one.csv", '{"Name":"Núñez, J.","Nationality":"X"}'),
        ("two.CSV", '{"Name":"line\\nbreak","Nationality":"Y"}'),
    ]
    spark.range(2).coalesce(1).write.parquet(str(root / "p"))
    both = S.read_tabular_payload(spark, str(root))
    assert both.count() == 5
    assert S.read_tabular_payload(spark, str(root), has_csv=False).count() == 2
    assert S.read_csv_payload(spark, str(root), multi_line=False).count() == 4


def test_append_raw(spark, tmp_path):
    path = str(tmp_path / "raw_league")
    df = spark.createDataFrame([("2025-08-01 10:00:00.7", 1, 2025, '{"a":1}')], "ingested_at string, league_id long, season int, payload string")
    S.append_raw(df, path)
    S.append_raw(df.limit(0), path)
    S.append_raw(df.drop("ingested_at"), path, loaded_at=F.lit("2025-08-02 00:00:00").cast("timestamp"))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|INVALID_JSON|parse"):
        S.append_raw(df.withColumn("payload", F.lit("{broken")), path)
    got = S.read_raw(spark, str(tmp_path), "RAW_League")
    assert rows(got.select("ingested_at", "league_id", "season", F.variant_get("payload", "$.a", "int"))) == [
        (dt.datetime(2025, 8, 1, 10, 0), 1, 2025, 1),
        (dt.datetime(2025, 8, 2), 1, 2025, 1),
    ]


def test_sources():
    assert len([s for s in S.SOURCES.values() if s.declared]) == 15
    assert S.resolve_source("RAW_TEAMS_Transfer") == S.resolve_source("RAW_TEAMS_TRANSFER") == "raw_teams_transfer"
    assert all(s.loaded_at == "ingested_at" for s in S.SOURCES.values())
    with pytest.raises(KeyError):
        S.resolve_source("raw_unknown")


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 8, 1),), (dt.datetime(2025, 8, 2),), (None,)], "ingested_at timestamp_ntz")
    got = S.source_freshness({"a": (df, "ingested_at"), "b": (df.limit(0), "ingested_at")}, F.lit("2025-08-03 00:00:00").cast("timestamp"))
    assert rows(got) == [("a", dt.datetime(2025, 8, 2), 86400), ("b", None, None)]


def test_freshness_from_marks_equals_the_scan(spark, tmp_path):
    path, marks = str(tmp_path / "raw_league"), str(tmp_path / "marks")
    day = F.lit("2025-08-09 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("2025-08-01 10:00:00.7", 1, "{}"), ("2025-08-03 10:00:00", 2, "{}"), (None, 3, "{}")], "ingested_at string, k long, payload string")
    for part in (df, df.limit(0), df.filter("k < 2"), df.filter("k = 3"), df.filter("k > 9")):
        S.append_raw(part, path, marks=marks)
        scanned = S.source_freshness({"raw_league": (spark.read.parquet(path), "ingested_at")}, day)
        assert rows(S.marked_freshness(spark, {"raw_league": marks}, day)) == rows(scanned)
    assert [r["n"] for r in spark.read.parquet(marks).orderBy("n").collect()] == [0, 0, 1, 1, 3]
    assert rows(S.marked_freshness(spark, {"none": str(tmp_path / "nothing")}, day)) == [("none", None, None)]


def test_export_json(spark, tmp_path):
    path = S.export_json(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "teams"), "20250816_142300")
    assert path.endswith("teams_20250816_142300")
    assert spark.read.text(path).first()[0] == '{"a":1,"b":null}'


def test_landed_fixture_reaches_the_dimension(spark, tmp_path):
    from pitchflow import plans

    body = {"parameters": {"league": "39", "season": "2025"}, "response": [{"fixture": {"id": 100}, "teams": {"home": {"id": 1}, "away": {"id": 2}}}]}
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "r.json").write_text(json.dumps(body) + "\n")
    landed = S.read_landed(spark, str(tmp_path / "landed"), {"league_id": "league", "season": "season"})
    S.append_raw(S.raw_rows(S.read_envelope(landed, "fixtures"), "raw_fixture_info"), str(tmp_path / "raw_fixture_info"))
    raw = S.read_raw(spark, str(tmp_path), "raw_fixture_info")
    got = plans.dim_fixture(plans.stg_fixture_info(raw)).first()
    assert (got.fixture_id, got.league_id, got.season) == (100, 39, 2025)
    assert rows(raw.select("home_team_id", "away_team_id")) == [(1, 2)]

    lineup = requests(spark, "league_id long, season int, fixture_id long", (39, 2025, 100, {"response": [{"team": {"id": 1}}, {"team": {"id": 2}}]}))
    items = S.read_envelope(lineup, "fixture_lineups", carry=("league_id", "season"))
    assert rows(S.raw_rows(items, "raw_fixture_line_up").select("league_id", "season", "fixture_id", "team_id")) == [(39, 2025, 100, 1), (39, 2025, 100, 2)]


def test_stored_payloads_are_read_by_path(spark, tmp_path):
    from pitchflow import plans

    df = spark.createDataFrame([(1, '{"fixture":{"id":1},"teams":{"home":{"id":5,"name":"R"}}}')], "fixture_id long, payload string")
    S.append_raw(df.selectExpr("1L AS league_id", "2025 AS season", "fixture_id", "1L AS home_team_id", "2L AS away_team_id", "payload"), str(tmp_path / "raw_fixture_info"))
    names = plans.stg_fixture_info(S.read_raw(spark, str(tmp_path), "raw_fixture_info")).select("home_team_name")
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert "variant_get" not in plan and "ReadSchema: struct<payload:struct<0:string>>" in plan
    assert names.first()[0] == "R"


def test_csv_files_with_their_own_headers(spark, tmp_path):
    import json

    from pitchflow import sources

    (tmp_path / "a.csv").write_text("Nationality,Name,Age\nDE,Bob,31\n")
    (tmp_path / "b.CSV").write_text("Name,Nationality\nAnn,\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "c.json").write_text("{}")
    found = sources.read_tabular_payload(spark, str(tmp_path)).selectExpr("source_file", "to_json(payload) AS p").collect()
    assert {r["source_file"]: json.loads(r["p"]) for r in found} == {
        "a.csv": {"Nationality": "DE", "Name": "Bob", "Age": "31"},
        "b.CSV": {"Name": "Ann", "Nationality": None},
    }


def test_parquet_files_with_other_columns_and_empty_folders(spark, tmp_path):
    from pitchflow import sources

    spark.sql("SELECT 1 AS a").write.parquet(str(tmp_path / "x"))
    spark.sql("SELECT 2 AS a, 'b' AS b").write.parquet(str(tmp_path / "y"))
    found = sources.read_tabular_payload(spark, str(tmp_path)).selectExpr("variant_get(payload, '$.a', 'int') a", "variant_get(payload, '$.b', 'string') b")
    assert sorted(map(tuple, found.collect())) == [(1, None), (2, "b")]
    (tmp_path / "none").mkdir()
    assert sources.read_tabular_payload(spark, str(tmp_path / "none")).count() == 0


def test_page_landed_twice_counts_as_it_is_merged(spark):
    from pitchflow import sources

    body = '{{"paging": {{"current": {}, "total": 2}}, "response": {}}}'
    pages = [(1, body.format(1, [1])), (1, body.format(1, [1, 2, 3])), (1, body.format(2, [4])), (2, '{"response": [1]}')]
    df = spark.createDataFrame(pages, "k long, body string")
    merged = sources.merge_pages(df, ["k"])
    assert merged.count() == 4
    counts = spark.createDataFrame([(1, 1, 2, 1), (1, 1, 2, 3), (1, 2, 2, 1)], "k long, page long, total long, n_items long")
    assert [tuple(r) for r in sources.page_status(counts, ["k"]).collect()] == [(1, 2, 4, True)]
    assert [r["k"] for r in sources.page_errors(df, ["k"]).collect()] == [2]


ODD_CSV = {
    "header_break": b'"Na\nme",Age\nBob,31\n',
    "repeated": b"A,B,A\n1,2,3\n",
    "empty_name": b"A,,C\n1,2,3\n",
    "beyond": b"A,B\n1,2,3,4\n5\n6,7,,\n",
    "backtick": b"c`d,e.f,$g\n1,2,3\n",
    "blank": b"\n\r\n\nA,B\n\n1,2\n\r\n3,4",
    "quotes": b'A,B\n"x ""y"" z",5" pipe\n"a"b"c,d\n"","\n"\n"",""\n',
    "breaks": b'A,B\r\n"one\r\n\r\ntwo, ""three""\n",x\r\n,y\r\n"z\n,\n,"" ","\n"\r\n',
    "only_header": b"A,B\n",
    "open": b'A,B\n1,2\n3,"4\n5,6',
    "bom": "\ufeffÄ,B\n日,\U0001d4b3\n".encode(),
}


def records_by_reader(data):
    """As a plain CSV reader has them: the last of equal names, cells beyond the header under null, empty cells NULL unless quoted."""
    import csv
    import io

    text = data.decode("utf-8-sig")
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    if not rows:
        return []
    out = []
    for r in rows[1:]:
        named = dict(zip(rows[0], r + [""] * (len(rows[0]) - len(r)), strict=False))
        named = {k: v or None for k, v in named.items()}
        if len(r) > len(rows[0]):
            named["null"] = [x or None for x in r[len(rows[0]) :]]
        out.append(named)
    return out


def payloads(df):
    import json

    out = {}
    for r in df.selectExpr("source_file", "to_json(payload) AS p").collect():
        out.setdefault(r["source_file"], []).append(json.loads(r["p"]))

    def plain(value):  # the plain reader cannot tell an empty cell from one of two quotes
        return [x or None for x in value] if isinstance(value, list) else value or None

    return {k: sorted(json.dumps({a: plain(b) for a, b in x.items()}, sort_keys=True) for x in v) for k, v in out.items()}


def wanted(files):
    import json

    every = {f"{name}.csv": sorted(json.dumps(x, sort_keys=True) for x in records_by_reader(data)) for name, data in files.items()}
    return {k: v for k, v in every.items() if v}


def test_csv_records_as_a_reader_has_them(spark, tmp_path):
    for name, data in ODD_CSV.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    assert payloads(S.read_csv_payload(spark, str(tmp_path))) == wanted(ODD_CSV)


def test_csv_records_across_blocks(spark, tmp_path):
    """Blocks of some hundred bytes: records and quotes go over their borders."""
    rng = random.Random(12)

    def cell():
        text = "".join(rng.choice(["a", "b c", ",", "\n", '"', "\r\n", "é", "1", "x" * 40]) for _ in range(rng.randint(0, 6)))
        plain = not any(c in text for c in ',\n\r"')
        return text if plain and rng.random() < 0.7 else '"' + text.replace('"', '""') + '"'

    files = {}
    for k in range(4):
        names = [f"c{j}" for j in range(rng.randint(1, 4))]
        lines = [",".join(cell() for _ in range(max(1, len(names) + rng.choice([0, 0, 0, 1, -1])))) for _ in range(150)]
        files[f"f{k}"] = (rng.choice(["\n", "\r\n"]).join([",".join(names), *lines]) + "\n").encode()
        (tmp_path / f"f{k}.csv").write_bytes(files[f"f{k}"])
    sizes = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        found = payloads(S.read_csv_payload(spark, str(tmp_path)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = wanted(files)
    assert {k: len(v) for k, v in found.items()} == {k: len(v) for k, v in want.items()}
    for name in want:
        assert [x for x in found[name] if x not in want[name]] == [x for x in want[name] if x not in found[name]]
