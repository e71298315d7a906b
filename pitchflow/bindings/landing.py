"""Envelopes, pages, tabular folders, RAW round trips and freshness over the given tables."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchflow import functions as P
from pitchflow import sources as S
from pitchflow.bindings.registry import query
from pitchflow.session import child_names, scratch_path

# One request per order: one to three fixtures, the first of some without an id, some responses missing.
RESPONSE = """
  to_json(struct(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE
    transform(sequence(0, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END), i -> struct(
      struct(CASE WHEN i = 0 AND o_orderpriority = '2-HIGH' THEN 0 ELSE o_orderkey * 10 + i END AS id,
             date_format(o_orderdate, 'yyyy-MM-dd') AS date) AS fixture,
      struct(struct(o_custkey AS id) AS home,
             struct(CASE WHEN i = 1 THEN o_custkey + 1 END AS id) AS away) AS teams)) END AS response)) AS body
"""


def _requests(t):
    return t.orders.selectExpr("o_orderkey AS league_id", "year(o_orderdate) AS season", RESPONSE)


ENVELOPE = """
    WITH r AS (SELECT *, unnest(range(0, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END)) AS i
               FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT o_orderkey AS league_id, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderkey * 10 + i AS fixture_id,
           o_custkey AS home_team_id, CASE WHEN i = 1 THEN o_custkey + 1 END AS away_team_id,
           strftime(o_orderdate, '%Y-%m-%d') AS fixture_date, i AS pos, 'football-api' AS source
    FROM r WHERE NOT (i = 0 AND o_orderpriority = '2-HIGH') AND o_orderkey * 10 + i <> 0
"""


@query("envelope_scan", ENVELOPE)
def envelope_scan(t):
    return S.read_envelope(_requests(t), "fixtures").drop("payload", "extracted_at")


@query("envelope_scan_limited", f"SELECT * FROM ({ENVELOPE}) WHERE pos < 2")
def envelope_scan_limited(t):
    return S.read_envelope(_requests(t), "fixtures", limit=2).drop("payload", "extracted_at")


@query(
    "envelope_errors",
    """
    SELECT o_orderkey AS fixture_id, CAST(i AS BIGINT) AS pos, k AS error_key, e AS error FROM (
      SELECT o_orderkey, unnest([0, 1]) AS i, NULL AS k, unnest(['rate limit', 'quota']) AS e FROM orders
      WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_orderkey, 0, NULL, 'plain text' FROM orders WHERE o_orderpriority = '2-HIGH'
      UNION ALL SELECT o_orderkey, 0, 'token', 'missing ' || o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
      UNION ALL SELECT o_orderkey, 0, 'envelope', 'missing or not JSON' FROM orders WHERE o_orderpriority = '5-LOW')
    """,
)
def envelope_errors(t):
    body = """CASE o_orderpriority
        WHEN '1-URGENT' THEN '{"errors": ["rate limit", "quota"], "error": "unused", "response": []}'
        WHEN '2-HIGH' THEN '{"errors": {}, "error": "plain text"}'
        WHEN '3-MEDIUM' THEN '{"errors": [], "response": [1]}'
        WHEN '4-NOT SPECIFIED' THEN concat('{"errors": {"token": "missing ', o_orderkey, '"}}')
        ELSE '<html>' END AS body"""
    return S.envelope_errors(t.orders.selectExpr("o_orderkey AS fixture_id", body), "fixture_events")


@query(
    "envelope_object",
    "SELECT o_orderkey AS league_id, CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey AS team_id,"
    " CAST(0 AS BIGINT) AS pos, 'football-api' AS source, o_orderpriority AS form FROM orders WHERE o_orderstatus <> 'P'",
)
def envelope_object(t):
    """Team statistics: the response is one object, and a request with errors gives no row."""
    body = """to_json(struct(CASE WHEN o_orderstatus = 'P' THEN array('no data') ELSE array() END AS errors,
                             struct(o_orderpriority AS form) AS response)) AS body"""
    requests = t.orders.selectExpr("o_orderkey AS league_id", "year(o_orderdate) AS season", "o_custkey AS team_id", body)
    rows = S.read_envelope(requests, "team_statistics")
    form = P.try_jget(F.col("payload"), "$.form", "string")
    return rows.select("league_id", "season", "team_id", "pos", "source", form.alias("form"))


@query(
    "envelope_nested",
    """
    SELECT p_partkey AS team_id, p_partkey * 100 + i AS player_id, CAST(i AS BIGINT) AS pos
    FROM (SELECT *, unnest(range(0, p_size)) AS i FROM part) WHERE i < 5 AND p_partkey * 100 + i <> 0
    UNION ALL SELECT p_partkey, p_partkey + 7, 0 FROM part
    """,
)
def envelope_nested(t):
    """Squads: players sit in a list inside each item; the limit counts per list."""
    body = """to_json(struct(array(
        struct(transform(sequence(0, p_size - 1), i -> struct(p_partkey * 100 + i AS id)) AS players),
        struct(array(struct(p_partkey + 7 AS id)) AS players)) AS response)) AS body"""
    rows = S.read_envelope(t.part.selectExpr("p_partkey AS team_id", body), "squads", limit=5)
    return rows.select("team_id", "player_id", "pos")


@query(
    "lineup_side",
    "SELECT o_orderkey AS fixture_id, o_custkey + i AS team_id, 'Team ' || i AS team_name,"
    " CASE i WHEN 0 THEN 'home' WHEN 1 THEN 'away' ELSE 'unknown_2' END AS side"
    " FROM (SELECT *, unnest(range(0, 3)) AS i FROM orders)",
)
def lineup_side(t):
    body = """to_json(struct(transform(sequence(0, 2), i ->
                struct(struct(o_custkey + i AS id, concat('Team ', i) AS name) AS team)) AS response)) AS body"""
    rows = S.read_envelope(t.orders.selectExpr("o_orderkey AS fixture_id", body), "fixture_lineups")
    return rows.select("fixture_id", "team_id", "team_name", "side")


@query(
    "landed_files",
    "SELECT c_custkey AS fixture_id, i + 1 AS event_no, c_name || ' ' || i AS detail"
    " FROM (SELECT *, unnest(range(0, 2)) AS i FROM customer)",
)
def landed_files(t):
    """Responses landed one per line, request keys taken from their parameters."""
    path = scratch_path(t.spark, "landed")
    text = """to_json(struct(struct(cast(c_custkey AS string) AS fixture) AS parameters, transform(sequence(0, 1),
                i -> struct(i + 1 AS no, concat(c_name, ' ', i) AS detail)) AS response)) AS value"""
    t.customer.selectExpr(text).write.text(path)
    rows = S.read_envelope(S.read_landed(t.spark, path, {"fixture_id": "fixture"}), "fixture_events")
    item = F.col("payload")
    detail = P.jget(item, "$.detail", "string")
    return rows.select("fixture_id", P.number(item, "$.no").alias("event_no"), detail.alias("detail"))


# Each order asks an endpoint once and gets two items; the second team of an open order has no id.
REQUEST_KEYS = {
    "league_id": ("o_custkey", "o_custkey"),
    "season": ("year(o_orderdate)", "CAST(year(o_orderdate) AS INTEGER)"),
    "team_id": ("o_custkey", "o_custkey"),
    "player_id": ("o_custkey", "o_custkey"),
    "fixture_id": ("o_orderkey", "o_orderkey"),
    "side": ("'home'", "'home'"),
}


def _register(name: str, spec: S.EndpointSpec) -> None:
    keys = ", ".join(f"{REQUEST_KEYS[k][1]} AS {k}" for k in spec.keys)
    team = ", CASE WHEN i = 0 OR o_orderstatus <> 'P' THEN o_custkey + 1 + i END AS team_id" if spec.ids else ""
    kept = " WHERE i = 0 OR o_orderstatus <> 'P'" if spec.required else ""
    items = "SELECT *, unnest(range(0, 2)) AS i FROM orders"

    @query(f"endpoint_{name}", f"SELECT {keys}{team}, i AS pos, o_orderkey * 2 + i AS n FROM ({items}){kept}")
    def rows(t):
        body = """to_json(struct(transform(sequence(0, 1), i -> struct(o_orderkey * 2 + i AS n, struct(
                    CASE WHEN i = 0 OR o_orderstatus <> 'P' THEN o_custkey + 1 + i END AS id) AS team)) AS response)) AS body"""
        requests = t.orders.selectExpr(*[f"{REQUEST_KEYS[k][0]} AS {k}" for k in spec.keys], body)
        found = S.read_envelope(requests, name)
        return found.select(*spec.keys, *spec.ids, "pos", P.number(F.col("payload"), "$.n").alias("n"))


for _name in (
    "leagues",
    "teams",
    "trophies",
    "transfers_by_player",
    "transfers_by_team",
    "player_statistics",
    "fixture_events",
    "fixture_statistics",
    "fixture_players",
    "predictions",
    "odds",
):
    _register(_name, S.ENDPOINTS[_name])


PAGES = """
    WITH p AS (SELECT conv_id, turn + 1 AS page, 6 AS total, CASE WHEN turn = 4 AND length(text) < 250 THEN 0 ELSE
                 len(string_split(text, chr(10))) END AS n_items, text FROM conversations),
    stops AS (SELECT conv_id, min(stop) AS last_page FROM (
      SELECT conv_id, page - 1 AS stop FROM p WHERE n_items = 0 UNION ALL
      SELECT conv_id, page FROM p WHERE page >= total UNION ALL
      SELECT conv_id, max(page) FROM p GROUP BY conv_id) GROUP BY conv_id)
"""


def _pages(t):
    """Each turn of a conversation is a page of six; some fifth pages came back empty."""
    body = """to_json(struct(struct(turn + 1 AS current, 6 AS total) AS paging,
                CASE WHEN turn = 4 AND length(text) < 250 THEN array() ELSE split(text, '\\n') END AS response)) AS body"""
    return t.conversations.selectExpr("conv_id", body)


@query(
    "merge_pages",
    f"""
    {PAGES}
    SELECT p.conv_id, page, CAST(i AS INTEGER) AS pos, string_split(text, chr(10))[i + 1] AS item
    FROM (SELECT *, unnest(range(0, n_items)) AS i FROM p) p JOIN stops s ON p.conv_id = s.conv_id WHERE page <= last_page
    """,
)
def merge_pages(t):
    items = S.merge_pages(_pages(t), ["conv_id"])
    return items.select("conv_id", "page", "pos", P.jget(F.col("payload"), "$", "string").alias("item"))


@query(
    "page_status",
    f"""
    {PAGES}
    SELECT s.conv_id, last_page, CAST(coalesce(sum(n_items) FILTER (WHERE page <= last_page), 0) AS BIGINT) AS results,
           last_page >= 6 AS complete
    FROM stops s JOIN p ON s.conv_id = p.conv_id GROUP BY s.conv_id, last_page
    """,
)
def page_status(t):
    body = P.parsed(_pages(t), "body")
    p = F.col("p")
    pages = body.select(
        "conv_id",
        P.number(p, "$.paging.current").alias("page"),
        P.number(p, "$.paging.total").alias("total"),
        P.array_size(p, "$.response").alias("n_items"),
    )
    return S.page_status(pages, ["conv_id"])


@query("csv_payload", "SELECT p_partkey, p_name, nullif(p_brand, 'Brand#1') AS p_brand, true AS is_csv, true AS has_brand FROM part")
def csv_payload(t):
    """Parts as a folder of CSV files and back; an empty cell keeps its key."""
    path = scratch_path(t.spark, "csv")
    parts = t.part.selectExpr("p_partkey", "p_name", "nullif(p_brand, 'Brand#1') AS p_brand", "p_size AS extra")
    orders = (["p_partkey", "p_name", "p_brand"], ["p_brand", "p_partkey", "p_name"], ["p_name", "extra", "p_brand", "p_partkey"])
    for k, columns in enumerate(orders):
        parts.filter(F.col("p_partkey") % 3 == k).select(columns).write.option("header", "true").csv(f"{path}/season{k}/parts")
    rows = S.read_csv_payload(t.spark, path)
    p = F.col("payload")
    return rows.select(
        P.jget(p, "$.p_partkey", "bigint").alias("p_partkey"),
        P.jget(p, "$.p_name", "string").alias("p_name"),
        P.jget(p, "$.p_brand", "string").alias("p_brand"),
        F.col("source_file").endswith(".csv").alias("is_csv"),
        P.try_jget(p, "$.p_brand", "variant").isNotNull().alias("has_brand"),
    )


def _name_as_csv(spark, path: str) -> None:
    """Give the text files of a folder the suffix of CSV files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in child_names(spark, path):
        if name.endswith(".txt"):
            fs.rename(hadoop(f"{path}/{name}"), hadoop(f"{path}/{name.removesuffix('.txt')}.csv"))


@query(
    "csv_records",
    """
    SELECT p_partkey AS key, p_type AS unnamed, p_brand AS last_a, p_name || chr(10) || '"' || p_type || '", ' || p_size AS name,
           CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS beyond
    FROM part
    """,
)
def csv_records(t):
    """Records over several lines under a header with a line break, a repeated, an empty and a quoted name; some have cells beyond it."""
    path = scratch_path(t.spark, "records")
    quoted = "concat('\"', replace(concat(p_name, '\\n', '\"', p_type, '\", ', p_size), '\"', '\"\"'), '\"')"
    cells = f"concat_ws(',', p_partkey, concat('\"', p_type, '\"'), 'first', {quoted}, p_brand, if(p_partkey % 7 <> 0, p_size, null))"
    lines = t.part.selectExpr(f"{cells} AS value", "p_partkey % 5 = 0 AS by_system")
    header = F.lit('c`d,,A,"Na\nme","A"\n')
    for by_system, end in ((True, "\r"), (False, "")):
        rows = lines.filter(F.col("by_system") == by_system)
        # the first row of a task stands below the header of its file, and behind a blank line
        first = F.monotonically_increasing_id() % F.lit(1 << 33) == 0
        below = F.when(first, F.concat(header, F.lit("\n"), "value")).otherwise(F.col("value"))
        rows.select(F.concat(below, F.lit(end)).alias("value")).write.text(f"{path}/{by_system}")
        _name_as_csv(t.spark, f"{path}/{by_system}")
    found = S.read_csv_payload(t.spark, path).select(F.variant_get("payload", "$", "map<string,variant>").alias("m"))

    def named(name: str, kind: str = "string"):
        return F.variant_get(F.element_at("m", F.lit(name)), "$", kind)

    return found.select(
        named("c`d", "bigint").alias("key"),
        named("").alias("unnamed"),
        named("A").alias("last_a"),
        named("Na\nme").alias("name"),
        F.variant_get(F.element_at("m", F.lit("null")), "$[0]", "string").alias("beyond"),
    )


@query(
    "tabular_payload",
    "SELECT s_suppkey AS key, s_name AS name, 'csv' AS suffix FROM supplier UNION ALL"
    " SELECT c_custkey, c_name, 'parquet' FROM customer",
)
def tabular_payload(t):
    """CSV and Parquet files side by side; the JSON among them is skipped."""
    path = scratch_path(t.spark, "tabular")
    t.supplier.selectExpr("s_suppkey AS key", "s_name AS name").write.option("header", "true").csv(f"{path}/a")
    t.customer.selectExpr("c_custkey AS key", "c_name AS name").write.parquet(f"{path}/b")
    t.nation.write.json(f"{path}/c")
    rows = S.read_tabular_payload(t.spark, path)
    p = F.col("payload")
    return rows.select(
        P.jget(p, "$.key", "bigint").alias("key"),
        P.jget(p, "$.name", "string").alias("name"),
        F.regexp_extract("source_file", r"\.([a-z]+)$", 1).alias("suffix"),
    )


@query(
    "source_freshness",
    """
    SELECT source, loaded_at, epoch(TIMESTAMP '2024-02-01' - loaded_at)::BIGINT AS lag_seconds FROM (
      SELECT 'events' AS source, date_trunc('second', max(ts)) AS loaded_at FROM events UNION ALL
      SELECT 'orders', max(o_orderdate) FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)
    """,
)
def source_freshness(t):
    loaded = t.events.select(P.to_ntz_seconds(F.col("ts")).alias("ingested_at"))
    tables = {"events": (loaded, "ingested_at"), "orders": (t.orders, "o_orderdate"), "lineitem": (t.lineitem, "l_shipdate")}
    return S.source_freshness(tables, F.lit("2024-02-01").cast("timestamp"))


@query(
    "marked_freshness",
    """
    SELECT 'events' AS source, date_trunc('second', max(ts)) AS loaded_at,
           epoch(TIMESTAMP '2024-02-01' - date_trunc('second', max(ts)))::BIGINT AS lag_seconds, count(*) AS n_rows FROM events
    """,
)
def marked_freshness(t):
    """Freshness of a table appended in three loads, from the rows that the appends committed, and not from the table."""
    path = scratch_path(t.spark, "marked")
    rows = t.events.selectExpr("event_id", "cast(ts AS string) AS ingested_at", "props AS payload")
    for k in range(3):
        S.append_raw(rows.filter(F.col("event_id") % 3 == k), f"{path}/raw", marks=f"{path}/marks")
    found = S.marked_freshness(t.spark, {"events": f"{path}/marks"}, F.lit("2024-02-01").cast("timestamp"))
    counted = t.spark.read.parquet(f"{path}/marks").agg(F.sum("n").alias("n_rows")).withColumn("source", F.lit("events"))
    return found.join(counted, "source")


@query(
    "raw_append_roundtrip",
    "SELECT event_id, date_trunc('second', ts) AS ingested_at, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k"
    " FROM events",
)
def raw_append_roundtrip(t):
    """Events appended to a RAW table in two loads and read back."""
    path = scratch_path(t.spark, "raw")
    rows = t.events.selectExpr("event_id", "cast(ts AS string) AS ingested_at", "props AS payload", "event_type")
    S.append_raw(rows.filter("event_type = 'click'").drop("event_type"), path)
    S.append_raw(rows.filter("event_type <> 'click'").drop("event_type"), path)
    stored = t.spark.read.parquet(path)
    return stored.select("event_id", "ingested_at", P.number(F.col("payload"), "$.k").alias("k"))


@query("json_export_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def json_export_roundtrip(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = S.export_json(rows, scratch_path(t.spark, "export"), "20250816_142300")
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "ledger_resume",
    """
    SELECT c_custkey, c_nationkey, c_mktsegment, CAST(1 AS BIGINT) AS times, c_nationkey % 2 = 0 AS early FROM customer
    """,
)
def ledger_resume(t):
    """A load of customers by nation and segment that stops in its third slice, behind rows that were never committed, goes on, and
    meets a second load of the same items: every customer is there once."""
    root = scratch_path(t.spark, "ledger")
    load = S.LedgerLoad(root, ("c_nationkey", "c_mktsegment"))
    entities = t.customer.select("c_nationkey", "c_mktsegment")
    calls = []

    def fetch(work, stop_at=None):
        calls.append(1)
        if len(calls) == stop_at:
            raise InterruptedError("stopped")
        return t.customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(work, list(load.keys), "left_semi")

    even = load.pending(entities.filter("c_nationkey % 2 = 0"))
    load.run(even, fetch, 2)
    early = load.done(t.spark).select("attempt").distinct()
    stopped = load.pending(entities)
    with suppress(InterruptedError):
        load.run(stopped, lambda work: fetch(work, 5), 4)
    load.write(fetch(stopped), "never-committed")
    again = load.pending(entities)
    load.run(again, fetch, 2)
    load.run(stopped, fetch, 1)  # by another process that had read its work before
    if load.pending(entities).take(1) or load.clear_stopped(t.spark) != ["never-committed"]:
        raise AssertionError("items are pending, or other rows than those of the stopped attempt were left")
    times = F.count(F.lit(1)).over(Window.partitionBy("c_custkey")).alias("times")
    by = load.done(t.spark).join(early.withColumn("early", F.lit(True)), "attempt", "left")
    by = by.select(*load.keys, F.coalesce("early", F.lit(False)).alias("early"))
    return load.read(t.spark).join(by, list(load.keys)).select("c_custkey", "c_nationkey", "c_mktsegment", times, "early")
