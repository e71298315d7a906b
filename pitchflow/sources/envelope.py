"""API responses: one envelope row in, one row per item out.

An envelope row holds the request keys (league, season, fixture, ...) and `body`, the response as
text or VARIANT: `{"response": [...], "errors": ..., "paging": {"current": 1, "total": 2}}`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.functions import elements, number, parsed, side_label, try_jget
from pitchflow.operators.flatten import flatten

SOURCE_LABEL = "football-api"


@dataclass(frozen=True)
class EndpointSpec:
    """How the items of one endpoint become rows.

    keys      request columns carried to every row
    ids       column -> JSON path inside an item, read as whole number
    texts     column -> JSON path inside an item, read as text
    required  id column without which (NULL or 0) an item is dropped
    nested    path of an inner list: rows are its elements instead of the items
    single    the response is one object, not a list
    sided     add `side` from the position of the item
    raw       RAW table the rows are appended to
    """

    keys: tuple[str, ...]
    raw: str
    ids: Mapping[str, str] = field(default_factory=dict)
    texts: Mapping[str, str] = field(default_factory=dict)
    required: str | None = None
    nested: str | None = None
    single: bool = False
    sided: bool = False


# Request keys, identifying paths and landing table of each endpoint.
ENDPOINTS: dict[str, EndpointSpec] = {
    "leagues": EndpointSpec(("league_id", "season"), "raw_league"),
    "teams": EndpointSpec(
        ("league_id", "season"), "raw_teams_info", ids={"team_id": "$.team.id"}, required="team_id"
    ),
    "team_statistics": EndpointSpec(("league_id", "season", "team_id"), "raw_teams_statistics", single=True),
    "squads": EndpointSpec(
        ("team_id",), "raw_teams_squads", ids={"player_id": "$.id"}, required="player_id", nested="$.players"
    ),
    "trophies": EndpointSpec(("team_id",), "raw_player_trophies"),
    "transfers_by_player": EndpointSpec(("player_id",), "raw_teams_transfer"),
    "transfers_by_team": EndpointSpec(("team_id",), "raw_teams_transfer"),
    "player_statistics": EndpointSpec(("league_id", "season", "team_id"), "raw_players_statistics"),
    "fixtures": EndpointSpec(
        ("league_id", "season"),
        "raw_fixture_info",
        ids={
            "fixture_id": "$.fixture.id",
            "home_team_id": "$.teams.home.id",
            "away_team_id": "$.teams.away.id",
        },
        texts={"fixture_date": "$.fixture.date"},
        required="fixture_id",
    ),
    "fixture_events": EndpointSpec(("fixture_id",), "raw_fixture_event"),
    "fixture_lineups": EndpointSpec(
        ("fixture_id",),
        "raw_fixture_line_up",
        ids={"team_id": "$.team.id"},
        texts={"team_name": "$.team.name"},
        sided=True,
    ),
    "fixture_statistics": EndpointSpec(("fixture_id", "team_id", "side"), "raw_fixture_statistics"),
    "fixture_players": EndpointSpec(("fixture_id", "team_id", "side"), "raw_fixture_players_statistic"),
    "predictions": EndpointSpec(("fixture_id",), "raw_fixture_predictions"),
    "odds": EndpointSpec(("fixture_id",), "raw_fixture_odds"),
}


def read_landed(spark: SparkSession, path: str, keys: Mapping[str, str], whole_files: bool = False) -> DataFrame:
    """Envelopes from landed responses, request keys read from `$.parameters`.

    `keys` maps a key column to its name in the request parameters, e.g. {"fixture_id": "fixture"}.
    Responses come one per line, which splits well, or with `whole_files` one per (indented) file.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=whole_files)
    body = parsed(text, "value", "body", keep_null=True)
    found = [
        F.try_variant_get("body", f"$.parameters['{name}']", "string").try_cast("bigint").alias(key)
        for key, name in keys.items()
    ]
    return body.select(*found, "body")


def read_envelope(
    df: DataFrame,
    endpoint: EndpointSpec | str,
    limit: int | None = None,
    as_of: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of the endpoint: keys, ids, [side,] pos, extracted_at, source, payload (VARIANT).

    A missing or empty response gives no rows. `limit` keeps the first items of each request (for a
    nested endpoint: of each inner list); it is a test on the ordinal, not a global limit. `carry`
    names further columns of the request to keep, such as the league and season of a fixture.
    """
    spec = ENDPOINTS[endpoint] if isinstance(endpoint, str) else endpoint
    spec = replace(spec, keys=(*carry, *spec.keys))
    body = parsed(df, "body", "_body")
    if spec.single:
        # a request that reports errors carries no statistics
        ok = body.filter(F.size(_error_entries(F.col("_body"))) == 0)
        items = ok.select(
            *spec.keys, F.lit(0).cast("bigint").alias("pos"), try_jget(F.col("_body"), "$.response", "variant").alias("payload")
        ).filter(F.col("payload").isNotNull())
    else:
        items = _explode_items(body, spec)
    if limit is not None:
        items = items.filter(F.col("pos") < limit)
    item = F.col("payload")
    out = items.select(
        *spec.keys,
        *[number(item, path).alias(name) for name, path in spec.ids.items() if name not in spec.keys],
        *[try_jget(item, path, "string").alias(name) for name, path in spec.texts.items()],
        *([side_label(F.col("pos")).alias("side")] if spec.sided else []),
        "pos",
        (F.current_timestamp() if as_of is None else as_of).alias("extracted_at"),
        F.lit(SOURCE_LABEL).alias("source"),
        "payload",
    )
    if spec.required:
        out = out.filter(F.col(spec.required).isNotNull() & (F.col(spec.required) != 0))
    return out


def _explode_items(body: DataFrame, spec: EndpointSpec) -> DataFrame:
    rows = body.select(*spec.keys, F.posexplode(elements(F.col("_body"), "$.response")).alias("pos", "payload"))
    if spec.nested:
        inner = elements(F.col("payload"), spec.nested)
        rows = rows.select(*spec.keys, F.posexplode(inner).alias("pos", "payload"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def _entries(v: Column) -> Column:
    """Entries of an error value as (key, error): list elements, object fields or one plain text."""
    # the three arms must agree on their type, null-ability included, hence the casts
    kind = "array<struct<key:string,error:string>>"
    listed = F.transform(
        F.try_variant_get(v, "$", "array<string>"), lambda x: F.struct(F.lit(None).cast("string"), x)
    ).cast(kind)
    named = F.map_entries(F.try_variant_get(v, "$", "map<string,string>")).cast(kind)
    text = F.nullif(F.try_variant_get(v, "$", "string"), F.lit(""))
    plain = F.when(text.isNotNull(), F.array(F.struct(F.lit(None).cast("string"), text))).cast(kind)
    return F.coalesce(listed, named, plain, F.array().cast(kind))


def _error_entries(body: Column) -> Column:
    """`errors` unless empty, else `error` unless empty, else nothing."""
    first = _entries(try_jget(body, "$.errors", "variant"))
    return F.when(F.size(first) > 0, first).otherwise(_entries(try_jget(body, "$.error", "variant")))


def envelope_errors(df: DataFrame, endpoint: EndpointSpec | str, carry: Sequence[str] = ()) -> DataFrame:
    """Errors reported by the requests: keys, pos, error_key (for an object), error.

    `carry` keeps further columns of the request, such as the batch of ids it asked for.

    A body that is missing or is not JSON is an error of its own, so a failed fetch leaves a trace.
    """
    spec = ENDPOINTS[endpoint] if isinstance(endpoint, str) else endpoint
    keys = (*carry, *spec.keys)
    body = parsed(df, "body", "_body", keep_null=True)
    missing = F.array(
        F.struct(F.lit("envelope").alias("key"), F.lit("missing or not JSON").alias("error"))
    ).cast("array<struct<key:string,error:string>>")
    entries = F.when(F.col("_body").isNull(), missing).otherwise(_error_entries(F.col("_body")))
    found = body.select(*keys, F.posexplode(entries).alias("pos", "_entry"))
    return found.select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_entry.key").alias("error_key"),
        F.col("_entry.error").alias("error"),
    )


def page_status(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How far each paged request got: keys, last_page, results, complete.

    Pages count from 1 while none is missing or empty, up to the first with current >= total; what
    lies beyond is not part of the result. `df` has keys, page, total, n_items; of a page landed twice the copy
    with more items counts, as in `merge_pages`.

    Each landed page also names its successor and page 1 as expected, and a slot that was expected
    but not landed is a gap. So every way to stop is seen per (keys, page), and a request with very
    many pages is never gathered in one place.
    """
    number_ = F.col("page").cast("bigint")

    def slot(page: Column, landed: bool) -> Column:
        known = F.lit(landed)
        return F.struct(
            page.alias("page"),
            known.alias("landed"),
            F.when(known, F.col("total").cast("bigint")).alias("total"),
            F.when(known, F.col("n_items").cast("bigint")).alias("n_items"),
        )

    expected = F.array(slot(number_, True), slot(number_ + 1, False), slot(F.lit(1).cast("bigint"), False))
    slots = (
        df.filter(F.col("page") >= 1)
        .select(*keys, F.inline(expected))
        .groupBy(*keys, "page")
        .agg(F.max("landed").alias("landed"), F.max(F.struct("n_items", "total")).alias("_copy"))
        .select(*keys, "page", "landed", "_copy.total", "_copy.n_items")
    )
    gap = ~F.col("landed") | (F.col("n_items") == 0)
    stop = F.when(gap, F.col("page") - 1).when(F.col("page") >= F.col("total"), F.col("page"))
    last = slots.groupBy(*keys).agg(F.min(stop).alias("last_page"))
    counted = _within(slots.filter("landed").select(*keys, "page", "total", "n_items"), last, keys)
    sums = counted.groupBy(*keys).agg(F.sum("n_items").alias("results"), F.max("total").alias("_total"))
    return last.join(sums, list(keys), "left").select(
        *keys,
        "last_page",
        F.coalesce("results", F.lit(0)).cast("bigint").alias("results"),
        F.coalesce(F.col("last_page") >= F.col("_total"), F.lit(False)).alias("complete"),
    )


def _within(pages: DataFrame, last: DataFrame, keys: Sequence[str], salts: int = 16) -> DataFrame:
    """Pages up to the last page of their request; the request table is repeated over `salts`."""
    salt = F.pmod(F.col("page"), F.lit(salts)).cast("int")
    wide = last.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = pages.withColumn("_salt", salt).join(wide, [*keys, "_salt"])
    return joined.filter(F.col("page") <= F.col("last_page")).drop("_salt", "last_page")


def page_errors(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Landed bodies that no page can be told of, because `paging` is missing or not a number: keys, error."""
    body = parsed(df, "body", "_body")
    current, total = (number(F.col("_body"), f"$.paging.{x}") for x in ("current", "total"))
    return body.filter(current.isNull() | total.isNull()).select(*keys, F.lit("no paging").alias("error"))


def merge_pages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of all valid pages of each paged request: keys, page, pos, payload.

    `df` has the keys and `body`, one row per landed page; of a page landed twice the copy with most items
    counts, of equally long ones that with the larger total, then hash.
    """
    body = parsed(df, "body", "_body")
    pages = body.select(
        *keys,
        number(F.col("_body"), "$.paging.current").alias("page"),
        number(F.col("_body"), "$.paging.total").alias("total"),
        elements(F.col("_body"), "$.response").alias("_items"),
    ).withColumn("n_items", F.coalesce(F.size("_items"), F.lit(0)).cast("bigint"))
    last = page_status(pages, keys).select(*keys, "last_page")
    items = _within(pages.select(*keys, "page", "total", "_items"), last, keys)
    best = F.struct(F.size("_items"), "total", F.xxhash64(F.transform("_items", lambda x: F.to_json(x))))
    once = items.groupBy(*keys, "page").agg(F.max_by("_items", best).alias("_items"))
    return once.select(*keys, "page", F.posexplode("_items").alias("pos", "payload"))
