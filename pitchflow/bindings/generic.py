"""Operators over the given tables: JSON access, reshaping, dedup, matching, incremental steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import functions as P
from pitchflow import operators as O
from pitchflow.bindings.registry import query
from pitchflow.plans import merge_incremental, read_incremental
from pitchflow.session import scratch_path

# `props` with some values that are not JSON: errors carry one brace too many.
NOISY = "CASE WHEN event_type = 'error' THEN '{' || props ELSE props END"


def _noisy(t):
    return t.events.select("event_id", F.expr(NOISY).alias("props"))


# --- semi-structured access -------------------------------------------------------------------


@query(
    "json_path_project",
    "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_path_project(t):
    rows = P.parsed(t.events.select("event_id", "user_id", "props"), "props")
    return rows.select("event_id", "user_id", P.number(F.col("p"), "$.k").alias("k"))


@query(
    "json_try_bad_input",
    f"""
    SELECT event_id, CAST(json_extract_string(j, '$.k') AS BIGINT) AS k
    FROM (SELECT event_id, {NOISY} AS j FROM events) WHERE json_valid(j)
    """,
)
def json_try_bad_input(t):
    return P.parsed(_noisy(t), "props").select("event_id", P.number(F.col("p"), "$.k").alias("k"))


@query(
    "wrap_bad_json",
    f"SELECT event_id, NOT json_valid(j) AS is_wrapped, CASE WHEN NOT json_valid(j) THEN j END AS raw"
    f" FROM (SELECT event_id, {NOISY} AS j FROM events)",
)
def wrap_bad_json(t):
    wrapped = _noisy(t).select("event_id", P.wrap_bad_json(F.col("props")).alias("v"))
    raw = P.try_jget(F.col("p"), "$._raw", "string")
    return P.parsed(wrapped, "v").select("event_id", raw.isNotNull().alias("is_wrapped"), raw.alias("raw"))


@query(
    "safe_path_default",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(-1 AS BIGINT) AS missing,"
    " 'none' AS wrong_container, event_id AS second_item, CAST(-1 AS BIGINT) AS beyond_end FROM events",
)
def safe_path_default(t):
    payload = F.expr("concat('{\"o\":', props, ',\"a\":[{\"b\":0},{\"b\":', event_id, '}]}')")
    p = F.col("p")
    return P.parsed(t.events.select("event_id", payload.alias("v")), "v").select(
        "event_id",
        P.safe_path(p, ["o", "k"], "bigint", -1).alias("k"),
        P.safe_path(p, ["o", "missing"], "bigint", -1).alias("missing"),
        P.safe_path(p, ["o", "k", "deeper"], "string", "none").alias("wrong_container"),
        P.safe_path(p, ["a", 1, "b"], "bigint", -1).alias("second_item"),
        P.safe_path(p, ["a", 9, "b"], "bigint", -1).alias("beyond_end"),
    )


@query("json_quoted_key", "SELECT event_id, event_id AS spaced, event_type AS marked FROM events")
def json_quoted_key(t):
    text = F.to_json(F.struct(F.col("event_id").alias("A b"), F.col("event_type").alias("\ufeffName")))
    p = F.col("p")
    return P.parsed(t.events.select("event_id", text.alias("v")), "v").select(
        "event_id",
        P.jget(p, P.field_path("A b"), "bigint").alias("spaced"),
        P.jget(p, P.field_path("\ufeffName"), "string").alias("marked"),
    )


KINDS = "CASE event_type WHEN 'click' THEN '[1]' WHEN 'view' THEN '1' WHEN 'error' THEN '{}' ELSE props END"


@query(
    "is_object_check",
    f"SELECT json_type(j) = 'OBJECT' AS is_object, count(*) AS n FROM (SELECT {KINDS} AS j FROM events) GROUP BY 1",
)
def is_object_check(t):
    rows = P.parsed(t.events.select(F.expr(KINDS).alias("v")), "v")
    return rows.groupBy(P.is_object(F.col("p")).alias("is_object")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "array_size",
    "SELECT p_partkey, CASE WHEN p_type <> 'SMALL' THEN len(string_split(p_name, ' ')) END AS n_words FROM part",
)
def array_size(t):
    text = F.expr("CASE WHEN p_type = 'SMALL' THEN to_json(named_struct('a', 1)) ELSE to_json(split(p_name, ' ')) END")
    rows = P.parsed(t.part.select("p_partkey", text.alias("v")), "v")
    return rows.select("p_partkey", P.array_size(F.col("p")).alias("n_words"))


def _part_words(t):
    return P.parsed(t.part.select("p_partkey", F.to_json(F.split("p_name", " ")).alias("v")), "v")


@query("flatten_inner", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def flatten_inner(t):
    rows = O.flatten(_part_words(t).select("p_partkey", "p"), F.col("p"))
    return rows.select("p_partkey", P.jget(F.col("value"), "$", "string").alias("word"))


@query(
    "flatten_ordinal",
    "SELECT p_partkey, i AS n, w[i] AS word FROM (SELECT p_partkey, string_split(p_name, ' ') AS w,"
    " unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part)",
)
def flatten_ordinal(t):
    rows = O.flatten(_part_words(t).select("p_partkey", "p"), F.col("p"), ordinal="pos")
    word = P.jget(F.col("value"), "$", "string")
    return rows.select("p_partkey", (F.col("pos") + 1).alias("n"), word.alias("word"))


@query(
    "flatten_nested",
    """
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    x AS (SELECT doc_id, i - 1 AS line_no, string_split(lines[i], ' ') AS words
          FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l))
    SELECT doc_id, line_no, j - 1 AS word_no, words[j] AS word
    FROM (SELECT *, unnest(range(1, len(words) + 1)) AS j FROM x)
    """,
)
def flatten_nested(t):
    """Lines and their words, each document one nested JSON text of its whole content."""
    nested = "to_json(struct(transform(split(text, '\\n'), l -> struct(split(l, ' ') AS statistics)) AS players))"
    docs = P.parsed(t.documents.select("doc_id", F.expr(nested).alias("v")), "v")
    lines = docs.select("doc_id", F.posexplode(P.elements(F.col("p"), "$.players")).alias("line_no", "line"))
    words = lines.select(
        "doc_id", "line_no", F.posexplode(P.elements(F.col("line"), "$.statistics")).alias("word_no", "w")
    )
    return words.select(
        "doc_id",
        F.col("line_no").cast("bigint").alias("line_no"),
        F.col("word_no").cast("bigint").alias("word_no"),
        P.jget(F.col("w"), "$", "string").alias("word"),
    )


# --- batches, sets, nested payloads -------------------------------------------------------------


@query(
    "batch_keys",
    """
    WITH d AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
    r AS (SELECT *, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 20 + 1 AS batch_no FROM d)
    SELECT l_suppkey, batch_no, count(*) AS n_ids, string_agg(l_partkey, '-' ORDER BY l_partkey) AS ids
    FROM r GROUP BY ALL
    """,
)
def batch_keys(t):
    return O.batch_keys(t.lineitem, "l_partkey", ["l_suppkey"], 20)


@query(
    "batch_keys_limited",
    """
    WITH d AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM d QUALIFY rn <= 7)
    SELECT o_custkey, (rn - 1) // 3 + 1 AS batch_no, count(*) AS n_ids,
           string_agg(o_orderkey, '-' ORDER BY o_orderkey) AS ids FROM r GROUP BY ALL
    """,
)
def batch_keys_limited(t):
    return O.batch_keys(t.orders, "o_orderkey", ["o_custkey"], 3, limit=7)


@query(
    "batch_keys_text",
    """
    WITH d AS (SELECT DISTINCT l_returnflag, md5(CAST(l_orderkey AS VARCHAR)) AS id FROM lineitem),
    r AS (SELECT *, (row_number() OVER (PARTITION BY l_returnflag ORDER BY id) - 1) // 20 + 1 AS batch_no FROM d)
    SELECT l_returnflag, batch_no, count(*) AS n_ids, string_agg(id, '-' ORDER BY id) AS ids FROM r GROUP BY ALL
    """,
)
def batch_keys_text(t):
    """Text ids, spread over their whole domain, of three hot keys."""
    rows = t.lineitem.select("l_returnflag", F.md5(F.col("l_orderkey").cast("string").cast("binary")).alias("id"))
    return O.batch_keys(rows, "id", ["l_returnflag"], 20)


@query(
    "batch_keys_sparse",
    """
    WITH d AS (SELECT DISTINCT l_linestatus, l_orderkey * 8589934609 - 4611686018427387 AS id FROM lineitem),
    r AS (SELECT *, (row_number() OVER (PARTITION BY l_linestatus ORDER BY id) - 1) // 20 + 1 AS batch_no FROM d)
    SELECT l_linestatus, batch_no, count(*) AS n_ids, string_agg(id, '-' ORDER BY id) AS ids FROM r GROUP BY ALL
    """,
)
def batch_keys_sparse(t):
    """Whole numbers far apart, of two hot keys."""
    rows = t.lineitem.selectExpr("l_linestatus", "l_orderkey * 8589934609 - 4611686018427387 AS id")
    return O.batch_keys(rows, "id", ["l_linestatus"], 20)


@query(
    "sorted_set",
    """
    WITH d AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
    r AS (SELECT *, (row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1) // 10 AS part FROM d)
    SELECT l_partkey, part, string_agg(l_suppkey, ',' ORDER BY l_suppkey) AS suppliers FROM r GROUP BY ALL
    """,
)
def sorted_set(t):
    sets = O.sorted_set(t.lineitem, ["l_partkey"], "l_suppkey", "ids", max_items=10)
    return sets.select("l_partkey", "part", P.join_ids(F.col("ids"), ",").alias("suppliers"))


@query(
    "collect_nested",
    """
    SELECT l_suppkey, CAST(0 AS BIGINT) AS part, count(*) AS n_items,
           string_agg(l_orderkey || ':' || l_linenumber, ',' ORDER BY l_orderkey, l_linenumber) AS items
    FROM lineitem GROUP BY l_suppkey
    """,
)
def collect_nested(t):
    rows = O.collect_nested(t.lineitem, ["l_suppkey"], ["l_orderkey", "l_linenumber"], max_items=1_000_000)
    text = F.transform("items", lambda x: F.concat(x["l_orderkey"].cast("string"), F.lit(":"), x["l_linenumber"].cast("string")))
    return rows.select("l_suppkey", "part", "n_items", F.array_join(text, ",").alias("items"))


@query(
    "collect_nested_parts",
    "SELECT l_returnflag, count(*) AS n_items, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct,"
    " CAST(sum(l_orderkey) AS BIGINT) AS key_sum, true AS within_bound FROM lineitem GROUP BY l_returnflag",
)
def collect_nested_parts(t):
    """Three keys hold everything: the parts stay small and together are the whole groups."""
    rows = O.collect_nested(t.lineitem, ["l_returnflag"], ["l_orderkey", "l_linenumber"], max_items=500)
    sizes = rows.withColumn("fits", F.col("n_items") <= 2000)
    item = F.explode("items").alias("item")
    flat = sizes.select("l_returnflag", "fits", item).select("l_returnflag", "fits", "item.*")
    return flat.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_distinct("l_orderkey", "l_linenumber").alias("n_distinct"),
        F.sum("l_orderkey").alias("key_sum"),
        F.every("fits").alias("within_bound"),
    )


@query(
    "compose_payload_parts",
    """
    WITH d AS (SELECT DISTINCT o_orderstatus, o_custkey FROM orders),
    k AS (SELECT o_orderstatus, count(*) AS n_responses, least(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 20) AS n_errors
          FROM orders GROUP BY 1)
    SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey) - 1 AS place,
           o_custkey AS id, n_responses, n_errors FROM d JOIN k USING (o_orderstatus)
    """,
)
def compose_payload_parts(t):
    """Keys of many parts: one list of ids and one of errors for each key, in the order of its parts."""
    rows = t.orders.selectExpr(
        "o_orderstatus",
        "o_custkey AS id",
        "to_json(struct(o_orderkey AS id)) AS payload",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN concat('late ', o_orderkey) END AS error",
    )
    made = P.parsed(O.compose_payload(rows, ["o_orderstatus"], "id", "payload", "error", max_items=100), "payload")
    p = F.col("p")
    read = made.select(
        "o_orderstatus",
        "part",
        P.jget(p, "$.ids", "array<bigint>").alias("ids"),
        P.array_size(p, "$.response").alias("n_responses"),
        P.array_size(p, "$.errors").alias("n_errors"),
    )
    totals = read.groupBy("o_orderstatus").agg(F.sum("n_responses").alias("n_responses"), F.sum("n_errors").alias("n_errors"))
    each = read.select("o_orderstatus", "part", F.posexplode("ids").alias("at", "id"))
    each = each.select("o_orderstatus", (F.col("part") * 100 + F.col("at")).alias("place"), "id")
    return each.join(totals, "o_orderstatus")


@query(
    "compose_payload",
    """
    SELECT o_custkey, CAST(0 AS BIGINT) AS part, count(*) AS n_items,
           string_agg(o_orderkey, '-' ORDER BY o_orderkey) AS ids,
           count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_responses,
           least(count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')), 4) AS n_errors,
           min(o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS first_response,
           'late ' || min(o_orderkey) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS first_error
    FROM orders GROUP BY o_custkey
    """,
)
def compose_payload(t):
    rows = t.orders.selectExpr(
        "o_custkey",
        "o_orderkey AS id",
        "CASE WHEN o_orderstatus <> 'P' THEN to_json(struct(o_orderkey AS id, o_orderstatus AS status)) END AS payload",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN concat('late ', o_orderkey) END AS error",
    )
    made = P.parsed(O.compose_payload(rows, ["o_custkey"], "id", "payload", "error", max_errors=4), "payload")
    p = F.col("p")
    return made.select(
        P.number(p, "$.o_custkey").alias("o_custkey"),
        "part",
        "n_items",
        F.array_join(P.jget(p, "$.ids", "array<string>"), "-").alias("ids"),
        P.array_size(p, "$.response").alias("n_responses"),
        P.array_size(p, "$.errors").alias("n_errors"),
        P.number(p, "$.response[0].id").alias("first_response"),
        P.jget(p, "$.errors[0]", "string").alias("first_error"),
    )


# --- work lists and live entities ----------------------------------------------------------------


@query(
    "pending_work",
    """
    SELECT c_custkey AS customer, season FROM customer, (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS season)
    WHERE (c_custkey, season) NOT IN (SELECT o_custkey, year(o_orderdate) FROM orders)
    """,
)
def pending_work(t):
    ledger = t.orders.select(F.col("o_custkey").alias("customer"), F.year("o_orderdate").alias("season"))
    customers = t.customer.select(F.col("c_custkey").alias("customer"))
    return O.pending_work(customers, ledger, {"season": range(1995, 2002)})


@query(
    "active_entities",
    "SELECT DISTINCT user_id FROM events WHERE event_type <> 'view'"
    " AND ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 3 DAYS AND (SELECT max(ts) FROM events)",
)
def active_entities(t):
    now = t.events.agg(F.max("ts")).scalar()
    return O.active_entities(t.events, "user_id", "ts", now, where=F.col("event_type") != "view")


@query(
    "live_status_filter",
    "SELECT event_id, event_type, 'live' AS feed_type FROM events WHERE event_type IN ('click', 'error')"
    " AND CAST(ts + INTERVAL 7 HOURS AS DATE) = DATE '2024-01-10'",
)
def live_status_filter(t):
    live = O.live_today(t.events, "ts", "event_type", dt.date(2024, 1, 10), ("click", "error"))
    return live.select("event_id", "event_type", "feed_type")


# --- one row per key ------------------------------------------------------------------------------


@query(
    "latest_by",
    "SELECT user_id, event_id, event_type, ts FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id) = 1",
)
def latest_by(t):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return O.latest_by(rows, ["user_id"], "ts", [F.col("event_id")])


@query(
    "latest_by_nulls",
    "SELECT user_id, event_id, seen FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN ts END AS seen"
    " FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seen DESC NULLS FIRST, event_id) = 1",
)
def latest_by_nulls(t):
    seen = F.when(F.col("event_type") != "error", F.col("ts"))
    rows = t.events.select("user_id", "event_id", seen.alias("seen"))
    return O.latest_by(rows, ["user_id"], "seen", [F.col("event_id")])


@query(
    "first_n_by",
    "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events"
    " QUALIFY rn <= 20",
)
def first_n_by(t):
    rows = t.events.select("user_id", "event_id", "ts")
    ranked = O.first_n_by(rows, ["user_id"], [F.col("ts"), F.col("event_id")], 20, "rn")
    return ranked.select("user_id", "event_id", F.col("rn").cast("bigint").alias("rn"))


@query(
    "group_max_dedup",
    """
    WITH g AS (SELECT c_nationkey, c_mktsegment, max(c_acctbal) AS c_acctbal FROM customer GROUP BY ALL)
    SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_mktsegment) = 1
    """,
)
def group_max_dedup(t):
    best = O.group_max(t.customer, ["c_nationkey", "c_mktsegment"], "c_acctbal")
    return O.latest_by(best, ["c_nationkey"], "c_acctbal", [F.col("c_mktsegment")])


@query("distinct_by_key", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_by_key(t):
    return O.distinct_by(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "payload_max",
    "SELECT user_id, max(k) AS k_text, count(*) AS n"
    " FROM (SELECT user_id, json_extract_string(props, '$.k') AS k FROM events) GROUP BY user_id",
)
def payload_max(t):
    """The largest payload per user by JSON text; VARIANT itself has no order."""
    rows = P.parsed(t.events.select("user_id", "props"), "props")
    text = F.to_json(F.struct(P.jget(F.col("p"), "$.k", "string").alias("k")))
    best = rows.groupBy("user_id").agg(F.max(text).alias("v"), F.count(F.lit(1)).alias("n"))
    return best.select("user_id", P.jget(F.parse_json("v"), "$.k", "string").alias("k_text"), "n")


# --- reshaping ------------------------------------------------------------------------------------

STAT_TEXT = """CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') || '%'
  WHEN 'error' THEN 'x' WHEN 'view' THEN CAST(value AS VARCHAR) ELSE json_extract_string(props, '$.k') END"""


@query(
    "pivot_max",
    f"""
    WITH s AS (SELECT user_id, event_type, {STAT_TEXT} AS v FROM events)
    SELECT user_id,
      max(CASE WHEN event_type = 'click' THEN CAST(replace(v, '%', '') AS BIGINT) END) AS clicks_pct,
      max(CASE WHEN event_type = 'click' THEN CAST(NULL AS BIGINT) END) AS clicks,
      CAST(NULL AS BIGINT) AS errors,
      CAST(max(CASE WHEN event_type = 'view' THEN TRY_CAST(v AS DECIMAL(38, 0)) END) AS BIGINT) AS views,
      max(CASE WHEN event_type = 'purchase' THEN CAST(v AS BIGINT) END) AS purchases
    FROM s GROUP BY user_id
    """,
)
def pivot_max(t):
    text = F.expr(
        """CASE event_type WHEN 'click' THEN concat(get_json_object(props, '$.k'), '%') WHEN 'error' THEN 'x'
             WHEN 'view' THEN cast(value AS string) ELSE get_json_object(props, '$.k') END"""
    )
    rows = t.events.select("user_id", "event_type", text.alias("v"))
    types = {
        "click": ("clicks_pct", P.percent_to_number),
        "error": ("errors", P.try_to_number),
        "view": ("views", P.try_to_number),
        "purchase": ("purchases", P.try_to_number),
    }
    wide = O.pivot_max(rows, ["user_id"], "event_type", "v", types)
    return wide.withColumn("clicks", F.lit(None).cast("bigint"))


@query(
    "rank_pivot",
    """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
               QUALIFY rn <= 20)
    SELECT o_custkey, max(o_totalprice) AS best_price,
      max(CASE WHEN rn = 1 THEN o_orderkey END) AS order_1_key, max(CASE WHEN rn = 1 THEN o_orderstatus END) AS order_1_status,
      max(CASE WHEN rn = 2 THEN o_orderkey END) AS order_2_key, max(CASE WHEN rn = 2 THEN o_orderstatus END) AS order_2_status,
      max(CASE WHEN rn = 3 THEN o_orderkey END) AS order_3_key, max(CASE WHEN rn = 3 THEN o_orderstatus END) AS order_3_status
    FROM r GROUP BY o_custkey
    """,
)
def rank_pivot(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ranked = O.first_n_by(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 20, "rn")
    fields = {"key": F.col("o_orderkey"), "status": F.col("o_orderstatus")}
    best = F.max("o_totalprice").alias("best_price")
    return O.rank_pivot(ranked, ["o_custkey"], "rn", fields, 3, [best], "order_{rank}_{field}")


@query(
    "union_padded",
    """
    WITH u AS (SELECT c_nationkey AS nation, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
               UNION ALL SELECT s_nationkey, s_name, s_acctbal, NULL FROM supplier)
    SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY nation ORDER BY balance DESC, name) = 1
    """,
)
def union_padded(t):
    schema = T.StructType.fromDDL("nation int, name string, balance double, segment string")
    customers = t.customer.selectExpr("c_nationkey nation", "c_name name", "c_acctbal balance", "c_mktsegment segment")
    suppliers = t.supplier.selectExpr("s_acctbal balance", "s_nationkey nation", "s_name name")
    both = O.union_padded(customers, suppliers, schema=schema)
    return O.latest_by(both, ["nation"], "balance", [F.col("name")])


@query(
    "unpivot_sides",
    "SELECT l_orderkey, l_linenumber, 'home' AS side, l_partkey AS id FROM lineitem UNION ALL"
    " SELECT l_orderkey, l_linenumber, 'away', l_suppkey FROM lineitem WHERE l_returnflag <> 'N'",
)
def unpivot_sides(t):
    rows = t.lineitem.withColumn("away", F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")))
    return O.unpivot_sides(rows, ["l_partkey"], ["away"], ["id"], ["l_orderkey", "l_linenumber"])


# --- matching --------------------------------------------------------------------------------------


@query(
    "lookup_by_id",
    """
    WITH last AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN last ON c_custkey = o_custkey
    """,
)
def lookup_by_id(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    joined = O.lookup(t.customer.select("c_custkey", "c_name"), orders, "c_custkey", newest, ["c_custkey"])
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


NAME_KEY = "regexp_replace(regexp_replace(lower(trim({0})), '[^a-z0-9 ]', '', 'g'), '\\s+', ' ', 'g')"


@query("name_key", f"SELECT doc_id, md5({NAME_KEY.format('text')}) AS key_md5 FROM documents")
def name_key(t):
    return t.documents.select("doc_id", F.md5(P.name_key(F.col("text"))).alias("key_md5"))


@query(
    "match_latest",
    """
    WITH best AS (SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier
                  QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) = 1)
    SELECT c_custkey, 'nation' || c_nationkey AS name_key, s_suppkey, s_acctbal
    FROM customer JOIN best ON c_nationkey = s_nationkey
    """,
)
def match_latest(t):
    customers = t.customer.select("c_custkey", F.expr("concat(' Nation-', c_nationkey)").alias("c_label"))
    suppliers = t.supplier.select("s_suppkey", "s_acctbal", F.expr("concat('NATION_', s_nationkey)").alias("s_label"))
    best = [F.col("s_acctbal").desc(), F.col("s_suppkey")]
    found = O.match_latest(customers, suppliers, "c_label", "s_label", ["c_custkey"], best)
    return found.select("c_custkey", "name_key", "s_suppkey", "s_acctbal")


@query(
    "unmatched_audit",
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'nation' || (c_nationkey + 10) END AS name_key"
    " FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey + 10 NOT IN (SELECT n_nationkey FROM nation)",
)
def unmatched_audit(t):
    label = F.expr("CASE WHEN c_mktsegment <> 'BUILDING' THEN concat('nation.', c_nationkey + 10) END")
    customers = t.customer.select("c_custkey", label.alias("label"))
    found = O.unmatched(customers, t.nation, "label", "n_name", ["c_custkey"])
    return found.select("c_custkey", "name_key")


@query(
    "null_safe_not_in",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE (o_custkey, o_orderstatus) NOT IN
      (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'O' END FROM customer)
    """,
)
def null_safe_not_in(t):
    status = F.when(F.col("c_acctbal") < 0, "F").otherwise("O").alias("o_orderstatus")
    known = t.customer.select(F.col("c_custkey").alias("o_custkey"), status)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    fresh = O.unseen(orders, known, ["o_custkey", "o_orderstatus"], spread_by=["o_orderkey"])
    return fresh.select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "not_in_null_keys",
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey,
                      CASE WHEN o_orderkey % 70 <> 1 THEN o_orderstatus END AS o_orderstatus FROM orders),
    c AS (SELECT CASE WHEN c_custkey % 500 <> 0 THEN c_custkey END AS k,
                 CASE WHEN c_custkey % 500 = 0 THEN 'P' WHEN c_custkey % 40 = 0 THEN NULL WHEN c_acctbal < 0 THEN 'F' ELSE 'O' END AS s
          FROM customer WHERE c_custkey % 3 <> 1)
    SELECT o_orderkey, o_custkey, o_orderstatus FROM o WHERE NOT EXISTS
      (SELECT 1 FROM c WHERE (o_custkey = k OR o_custkey IS NULL OR k IS NULL) AND (o_orderstatus = s OR o_orderstatus IS NULL OR s IS NULL))
    """,
)
def not_in_null_keys(t):
    """NOT IN over two keys with NULLs on both sides, as SQL has it."""
    custkey = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey")
    status = F.when(F.col("o_orderkey") % 70 != 1, F.col("o_orderstatus")).alias("o_orderstatus")
    known_status = (
        F.when(F.col("c_custkey") % 500 == 0, "P").when(F.col("c_custkey") % 40 == 0, F.lit(None)).when(F.col("c_acctbal") < 0, "F").otherwise("O")
    )
    known = t.customer.filter("c_custkey % 3 <> 1").select(
        F.when(F.col("c_custkey") % 500 != 0, F.col("c_custkey")).alias("o_custkey"), known_status.alias("o_orderstatus")
    )
    return O.not_in(t.orders.select("o_orderkey", custkey, status), known, ["o_custkey", "o_orderstatus"])


# --- events and increments -------------------------------------------------------------------------

EVENT_FACT = """
    SELECT event_type || ':' || user_id || ':' || event_id AS event_id, user_id, event_type, value,
           coalesce(CASE WHEN event_type <> 'error' THEN ts END, date_trunc('day', ts)) AS event_time
    FROM events
"""


def _event_fact(t):
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    return t.events.select(
        P.event_id(F.col("event_type"), F.col("user_id"), F.col("event_id")).alias("event_id"),
        "user_id",
        "event_type",
        "value",
        P.event_time(known, F.date_trunc("day", "ts")).alias("event_time"),
    )


@query("event_fact", EVENT_FACT)
def event_fact(t):
    return _event_fact(t)


@query(
    "event_goal_view",
    f"SELECT event_id, user_id AS scorer_id, event_time FROM ({EVENT_FACT}) WHERE event_type = 'purchase'",
)
def event_goal_view(t):
    goals = _event_fact(t).filter(F.lower("event_type") == "purchase")
    return goals.select("event_id", F.col("user_id").alias("scorer_id"), "event_time")


@query(
    "event_card_view",
    f"SELECT event_id, user_id, CASE event_type WHEN 'error' THEN 'red' ELSE 'yellow' END AS card_color"
    f" FROM ({EVENT_FACT}) WHERE event_type IN ('error', 'signup')",
)
def event_card_view(t):
    detail = F.when(F.col("event_type") == "error", "Straight RED").otherwise("Second Yellow card")
    cards = _event_fact(t).filter(F.lower("event_type").isin("error", "signup"))
    return cards.select("event_id", "user_id", P.card_color(detail).alias("card_color"))


@query(
    "event_sub_view",
    f"SELECT event_id, user_id AS player_out_id, event_time FROM ({EVENT_FACT}) WHERE event_type = 'click'",
)
def event_sub_view(t):
    subs = _event_fact(t).filter(F.lower("event_type").isin("click"))
    return subs.select("event_id", F.col("user_id").alias("player_out_id"), "event_time")


@query("incremental_append", "SELECT event_id, user_id, ts FROM events")
def incremental_append(t):
    """Half a month first, then everything twice over: each event once."""
    path = scratch_path(t.spark, "incremental")
    rows = t.events.select("event_id", "user_id", "ts")
    merge_incremental(rows.filter(F.dayofmonth("ts") < 15), path, ["event_id"], "event_id")
    merge_incremental(rows.unionByName(rows), path, ["event_id"], "event_id")
    return read_incremental(t.spark, path, rows.schema, "event_id")


@query(
    "upsert_latest",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS version
    FROM orders UNION ALL SELECT -1 - o_orderkey, 'N', 1 FROM orders WHERE o_orderstatus = 'F'
    """,
)
def upsert_latest(t):
    orders = t.orders
    target = orders.selectExpr("o_orderkey", "o_orderstatus AS status", "0 AS version")
    open_orders = orders.filter("o_orderstatus = 'P'").selectExpr("o_orderkey", "'X' AS status", "explode(array(1, 2)) AS version")
    new = orders.filter("o_orderstatus = 'F'").selectExpr("-1 - o_orderkey AS o_orderkey", "'N' AS status", "1 AS version")
    return O.upsert(target, open_orders.unionByName(new), ["o_orderkey"], [F.col("version").desc()])


@query(
    "epoch_ms_to_ts",
    "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at, date_trunc('second', ts) AS at_second FROM events",
)
def epoch_ms_to_ts(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        P.epoch_ms_to_ntz(ms).alias("at"),
        P.to_ntz_seconds(F.col("ts").cast("string")).alias("at_second"),
    )


@query("utf8_text", "SELECT doc_id, text, length(text) AS n FROM documents")
def utf8_text(t):
    text = P.utf8_text(F.encode("text", "UTF-8"))
    return t.documents.select("doc_id", text.alias("text"), F.length(text).cast("bigint").alias("n"))
