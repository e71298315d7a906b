"""Data-quality checks over the given tables and over every staging model."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchflow import plans
from pitchflow import quality as Q
from pitchflow.bindings import derived
from pitchflow.bindings.registry import ORACLES, Tables, query
from pitchflow.session import scratch_path

NULLED = "CASE WHEN event_type <> 'error' THEN value END"


def _events(t):
    return t.events.select("event_id", "user_id", "event_type", F.expr(NULLED).alias("value"))


@query("dq_not_null", f"SELECT event_id FROM (SELECT event_id, {NULLED} AS v FROM events) WHERE v IS NULL")
def dq_not_null(t):
    return Q.failing_rows(_events(t), Q.not_null("value")).select("event_id")


@query(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dq_unique(t):
    return Q.failing_rows(t.lineitem, Q.unique_combination(["l_orderkey", "l_linenumber"]))


@query(
    "dq_range",
    "SELECT event_id, value FROM events WHERE event_type = 'click' AND NOT (value > 5 AND value < 40)",
)
def dq_range(t):
    check = Q.accepted_range("value", 5, 40, inclusive=False, where="event_type = 'click'")
    return Q.failing_rows(_events(t), check).select("event_id", "value")


@query(
    "dq_expression",
    "SELECT event_id FROM events WHERE event_type <> 'error' AND NOT (value >= 5 OR event_type = 'view')",
)
def dq_expression(t):
    """A condition that is NULL passes."""
    return Q.failing_rows(_events(t), Q.expression_is_true("value >= 5 or (event_type = 'view' and value is not null)")).select(
        "event_id"
    )


@query(
    "dq_relationships",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def dq_relationships(t):
    return Q.relationships(t.documents, t.labels, "doc_id", "doc_id", ["doc_id"]).select("doc_id")


@query(
    "dq_relationships_large",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
)
def dq_relationships_large(t):
    final = t.orders.filter("o_orderstatus = 'F'")
    rows = Q.relationships(t.lineitem, final, "l_orderkey", "o_orderkey", ["l_linenumber", "l_partkey"])
    return rows.select("l_orderkey", "l_linenumber")


@query(
    "dq_report",
    f"""
    WITH e AS (SELECT event_id, user_id, {NULLED} AS value FROM events),
    r AS (
      SELECT 'not_null' AS test, 'value' AS "column", 'error' AS severity, count(*) FILTER (WHERE value IS NULL) AS failures FROM e
      UNION ALL SELECT 'accepted_range', 'value', 'warn', count(*) FILTER (WHERE value > 60) FROM e
      UNION ALL SELECT 'not_null', 'event_id', 'error', 0
      UNION ALL SELECT 'unique_combination', 'user_id', 'warn', count(*) FROM (SELECT user_id FROM e GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'unique_combination', 'event_id', 'error', count(*) FROM (SELECT event_id FROM e GROUP BY 1 HAVING count(*) > 1))
    SELECT 'events' AS model, test, "column", severity, failures, failures = 0 AS passed FROM r
    """,
)
def dq_report(t):
    return Q.run_checks(_events(t), _event_checks(), "events")


def _event_checks():
    return [
        Q.not_null("value"),
        Q.accepted_range("value", max_value=60, severity="warn"),
        Q.not_null("event_id"),
        Q.unique_combination(["user_id"], severity="warn"),
        Q.unique_combination(["event_id"]),
    ]


@query("dq_incremental_report", ORACLES["dq_report"])
def dq_incremental_report(t):
    """The same report from three loads, one of them added twice."""
    spark = t.events.sparkSession
    states = Q.check_states(scratch_path(spark, "states"), _event_checks(), "events", ranges=16)
    for load, kind in (("a", "event_type = 'click'"), ("b", "event_type = 'error'"), ("b", "event_type = 'error'"), ("c", "event_type not in ('click', 'error')")):
        states.add(_events(t).filter(kind), load)
    return states.report(spark)


# Failure conditions, over the SQL twin of the staging model, of the checks that are not plain
# null or uniqueness tests, and of null tests on JSON columns the twin shows differently.
FAILURES = {
    "stg_league": {"country_code": "NOT regexp_full_match(country_code, '[A-Z]{2}(-[A-Z]{3})?')"},
    "stg_fixture_statistics": {
        "ball_possession_pct": "NOT ball_possession_pct BETWEEN 0 AND 100",
        "passes_pct": "NOT passes_pct BETWEEN 0 AND 100",
    },
    "stg_fixture_info": {"payload_response": "false"},
    "stg_team_statistics": {
        "fixtures_played_total": "fixtures_played_total < 0",
        "goals_for_total": "goals_for_total < 0",
        "goals_against_total": "goals_against_total < 0",
    },
    "stg_fixture_line_up": {"start_xi_json": "start_xi_cnt <> 11", "substitutes_json": "substitutes_cnt < 0"},
    "stg_fixture_predictions": {
        "percent_away": "NOT percent_away BETWEEN 0 AND 100",
        "percent_home": "NOT percent_home BETWEEN 0 AND 100",
        "percent_draw": "NOT percent_draw BETWEEN 0 AND 100",
        "percent_sum": "NOT percent_away + percent_home + percent_draw BETWEEN 99 AND 101",
    },
    "stg_player_trophies": {
        "payload_json": "false",
        "trophy_1": "trophy_1_league IS NULL OR trophy_1_season IS NULL",
    },
    "stg_players_statistics": {
        "games_json": "NOT has_passes",
        "goals_json": "NOT has_passes",
        "passes_json": "NOT has_passes",
        "player_age": "NOT player_age BETWEEN 15 AND 50",
        "player_photo_url": "NOT player_photo_url LIKE 'https:%'",
    },
    "stg_fixture_players_statistics": {
        "offsides": "NOT offsides BETWEEN 0 AND 20",
        "any_section": "false",
        **{f"{s}_json": "false" for s in Q.specs.MATCH_SECTIONS},
    },
    "stg_kafka_fixture_live_events": {"message_key": "CAST(message_key AS BIGINT) <> fixture_id"},
}


def _twin_report(model: str) -> str:
    """SQL counting the failures of a model's checks on the SQL twin of its rows."""
    lines = []
    for check in Q.CHECKS[model]:
        if check.unique:
            names = ", ".join(f'"{c}"' for c in check.unique)
            failing = f"(SELECT count(*) FROM (SELECT 1 FROM m GROUP BY {names} HAVING count(*) > 1))"
        else:
            special = FAILURES.get(model, {}).get(check.column)
            plain = check.kind == "not_null" and (special is None or not check.column.endswith(("_json", "_response")))
            condition = f'"{check.column}" IS NULL' if plain else special
            failing = f"(SELECT count(*) FROM m WHERE {condition})"
        lines.append(
            f"SELECT '{check.kind}' AS test, '{check.column}' AS \"column\", '{check.severity}' AS severity, {failing} AS failures"
        )
    union = "\n UNION ALL ".join(lines)
    return (
        f"WITH m AS ({ORACLES[model]}), r AS ({union})"
        f" SELECT '{model}' AS model, test, \"column\", severity, failures, failures = 0 AS passed FROM r"
    )


def _register(model: str) -> None:
    @query(f"dq_{model}", _twin_report(model))
    def report(t: Tables):
        spec = plans.MODELS[model]
        staged = spec.build(*[derived.source(t, i) for i in spec.inputs])
        return Q.run_checks(staged, Q.CHECKS[model], model)


for _model in Q.CHECKS:
    _register(_model)
