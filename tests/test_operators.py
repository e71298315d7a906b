"""Operators on small inputs, with skew, copies and order changes."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import operators as O
from pitchflow.functions import elements, parsed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def skewed(n=3000, seed=7):
    """(key, id) with a third of the rows on key 0, repeats included."""
    rng = random.Random(seed)
    return [(0 if i % 3 == 0 else rng.randrange(1, 40), rng.randrange(500)) for i in range(n)]


def test_latest_by_null_is_newest_and_ties_are_stable(spark):
    data = [(1, 5, "a"), (1, None, "b"), (2, 7, "d"), (2, 7, "c"), (3, 1, "e")]
    want = [(1, None, "b"), (2, 7, "c"), (3, 1, "e")]
    for order in itertools.permutations(data):
        df = spark.createDataFrame(list(order), "k int, at int, v string")
        assert rows(O.latest_by(df, ["k"], "at", [F.col("v")])) == want
        break
    df = spark.createDataFrame(data[::-1], "k int, at int, v string").repartition(7)
    assert rows(O.latest_by(df, ["k"], "at", [F.col("v")])) == want


def test_latest_by_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = O.latest_by(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("n", [1, 20, 1500])
def test_first_n_by_matches_brute_force(spark, n):
    data = [(k, i) for i, (k, _) in enumerate(skewed(6000))]
    got = rows(O.first_n_by(spark.createDataFrame(data, "k int, v int"), ["k"], [F.col("v")], n, "rn"))
    want = []
    for k in {k for k, _ in data}:
        mine = sorted(v for kk, v in data if kk == k)[:n]
        want += [(k, v, i + 1) for i, v in enumerate(mine)]
    assert got == sorted(want, key=repr)


def test_rank_within_crosses_ranges(spark):
    data = [*skewed(), (None, 3), (None, 999), (5, -40)]
    got = rows(O.rank_within(spark.createDataFrame(data, "k int, id int"), ["k"], "id"))
    want = []
    for k in {k for k, _ in data}:
        want += [(k, v, i + 1) for i, v in enumerate(sorted({v for kk, v in data if kk == k}))]
    assert got == sorted(want, key=repr)


def test_batch_keys(spark):
    data = skewed(900)
    got = rows(O.batch_keys(spark.createDataFrame(data, "k int, id int"), "id", ["k"], 20))
    want = []
    for k in {k for k, _ in data}:
        ids = sorted({v for kk, v in data if kk == k})
        for b in range(0, len(ids), 20):
            part = ids[b : b + 20]
            want.append((k, b // 20 + 1, len(part), "-".join(map(str, part))))
    assert got == sorted(want, key=repr)


def test_batch_keys_of_text_and_of_sparse_ids(spark):
    data = [(i % 2 if i % 5 else None, f"id{i * 7919 % 1000:03d}") for i in range(400)] * 2
    got = rows(O.batch_keys(spark.createDataFrame(data, "k int, id string"), "id", ["k"], 30))
    want = []
    for k in {k for k, _ in data}:
        ids = sorted({v for kk, v in data if kk == k})
        want += [(k, b // 30 + 1, len(ids[b : b + 30]), "-".join(ids[b : b + 30])) for b in range(0, len(ids), 30)]
    assert got == sorted(want, key=repr)
    sparse = spark.range(20_000).select(F.lit(1).alias("k"), F.xxhash64("id").alias("id"))
    ranked = O.rank_within(sparse, ["k"], "id")
    ids = [r.id for r in ranked.orderBy("rank").collect()]
    assert ids == sorted(ids) and len(ids) == 20_000
    assert ranked.agg(F.max("rank")).first()[0] == 20_000


def test_collect_nested_keeps_everything_in_bounded_parts(spark):
    data = [(0, 1)] * 700 + [(0, i) for i in range(900)] + [(1, 5)] * 3 + [(None, 2)] * 2
    got = O.collect_nested(spark.createDataFrame(data, "k int, id int").repartition(5), ["k"], ["id"], max_items=50).collect()
    assert max(r.n_items for r in got) <= 150
    assert all(len(r["items"]) == r.n_items for r in got)
    flat = sorted(((r.k, x.id) for r in got for x in r["items"]), key=repr)
    assert flat == sorted(data, key=repr)
    small = [r for r in got if r.k == 1]
    assert len(small) == 1 and small[0].part == 0 and [x.id for x in small[0]["items"]] == [5, 5, 5]


def test_compose_payload(spark):
    data = [
        (10, 7, '{"id":7}', None),
        (10, 3, None, "timeout"),
        (10, 5, '{"id":5,"a":[1]}', None),
        (11, 1, None, None),
    ]
    df = spark.createDataFrame(data, "team_id long, id long, payload string, error string")
    got = rows(O.compose_payload(df, ["team_id"], "id", "payload", "error"))
    assert got == [
        (10, 0, 3, '{"team_id":10,"ids":[3,5,7],"response":[{"a":[1],"id":5},{"id":7}],"errors":["timeout"]}'),
        (11, 0, 1, '{"team_id":11,"ids":[1],"response":[],"errors":[]}'),
    ]


def test_compose_payload_keeps_the_first_errors(spark):
    data = [(1, i, None, f"e{i:02d}") for i in range(30)]
    df = spark.createDataFrame(data, "k long, id long, payload string, error string")
    payload = O.compose_payload(df, ["k"], "id", "payload", "error", max_errors=20).first().payload
    assert payload.count('"e') - payload.count('"errors"') == 20 and '"e19"' in payload and '"e20"' not in payload


def test_compose_payload_has_the_errors_of_a_key_once(spark):
    data = [(1, i, f'{{"n":{i}}}', f"e{i:02d}") for i in range(90)] + [(None, 1, None, "x")]
    df = spark.createDataFrame(data, "k long, id long, payload string, error string")
    made = O.compose_payload(df, ["k"], "id", "payload", "error", max_items=30).collect()
    assert sum(r.payload.count('"e') - r.payload.count('"errors"') for r in made) == 20
    assert sum(r.n_items for r in made) == 91 and len(made) > 2


def test_compose_payload_has_one_list_of_ids_per_key(spark):
    data = [(1, i % 70, f'{{"n":{i}}}') for i in range(200)] + [(2, 9, None), (2, 3, '{"n":0}'), (None, None, '{"n":1}'), (None, 4, None)]
    df = spark.createDataFrame(data, "k long, id long, payload string")
    made = O.compose_payload(df, ["k"], "id", "payload", max_items=30).orderBy("k", "part").collect()
    bodies = [(r.k, r.part, json.loads(r.payload)) for r in made]
    assert [i for k, _, b in bodies if k == 1 for i in b["ids"]] == list(range(70))
    assert sorted(x["n"] for k, _, b in bodies if k == 1 for x in b["response"]) == list(range(200))
    assert [(p, b["ids"], len(b["response"])) for k, p, b in bodies if k == 2] == [(0, [3, 9], 1)]
    assert [(p, b["ids"], len(b["response"])) for k, p, b in bodies if k is None] == [(0, [4], 1)]
    assert sum(r.n_items for r in made) == 204


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_spread_join_equals_join(spark, how):
    data = [(k if k % 5 else None, i) for i, (k, _) in enumerate(skewed(2000))]
    left = spark.createDataFrame(data, "k int, i int")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 30, 2)], "k int, v string")
    plain = left.join(right, ["k"], how)
    assert rows(O.spread_join(left, right, ["k"], how, ["i"], salts=8)) == rows(plain)


def test_match_latest_equals_many_to_many(spark):
    players = spark.createDataFrame([(1, "José A"), (2, "JOSE  A"), (3, "jos a"), (4, None), (5, "Ж")], "id int, name string")
    managers = spark.createDataFrame(
        [("jos  a", 1), ("Jos A!", 3), ("jose a", None), ("Я", 9), (None, 10)], "m_name string, at int"
    )
    got = rows(
        O.match_latest(players, managers, "name", "m_name", ["id"], [F.col("at").desc_nulls_first()]).select("id", "m_name", "at")
    )
    assert got == [(1, "Jos A!", 3), (2, "jose a", None), (3, "Jos A!", 3), (5, "Я", 9)]
    long_only = O.match_latest(players, managers, "name", "m_name", ["id"], [F.col("at").desc_nulls_first()], min_key_length=1)
    assert rows(long_only.select("id")) == [(1,), (2,), (3,)]


def test_unmatched_keeps_null_names(spark):
    left = spark.createDataFrame([("A b",), ("c",), (None,)], "n string")
    right = spark.createDataFrame([("a B",), (None,)], "r string")
    assert rows(O.unmatched(left, right, "n", "r", ["n"]).select("n")) == [("c",), (None,)]


def test_flatten(spark):
    data = [(1, '{"x":[1,null,{"q":2}]}'), (2, '{"x":[]}'), (3, "{}"), (4, '{"x":5}'), (5, '{"x":null}'), (6, '{"x":{"k":1}}')]
    df = parsed(spark.createDataFrame(data, "id int, v string"), "v").select("id", "p")
    got = O.flatten(df, F.try_variant_get("p", "$.x", "variant"), ordinal="pos", key="key")
    assert rows(got.select("id", "pos", "key", F.to_json("value"))) == [
        (1, 0, None, "1"),
        (1, 1, None, "null"),
        (1, 2, None, '{"q":2}'),
        (6, 0, "k", "1"),
    ]
    assert df.select("id", F.explode(elements(F.col("p"), "$.x"))).count() == 3


def test_pivot_and_rank_pivot(spark):
    df = spark.createDataFrame([(1, "a", "3"), (1, "a", "10"), (1, "b", "x"), (2, "z", "1")], "k int, t string, v string")
    as_int = lambda c: c.try_cast("int")
    assert rows(O.pivot_max(df, ["k"], "t", "v", {"a": ("a", as_int), "b": ("b", as_int)})) == [(1, 10, None), (2, None, None)]
    ranked = O.first_n_by(df, ["k"], [F.col("v")], 2, "rn")
    got = O.rank_pivot(ranked, ["k"], "rn", {"v": F.col("v")}, 2, [F.count(F.lit(1)).alias("n")])
    assert got.columns == ["k", "n", "1_v", "2_v"]
    assert rows(got) == [(1, 2, "10", "3"), (2, 1, "1", None)]


def test_union_padded_and_unpivot(spark):
    schema = T.StructType.fromDDL("a int, b string")
    one = spark.createDataFrame([(1,)], "a int")
    two = spark.createDataFrame([("x", 2)], "b string, a int")
    assert rows(O.union_padded(one, two, schema=schema)) == [(1, None), (2, "x")]
    df = spark.createDataFrame([(9, 1, None, "h", "a")], "f int, h int, a int, hn string, an string")
    got = O.unpivot_sides(df, ["h", "hn"], ["a", "an"], ["id", "name"], ["f"])
    assert rows(got) == [(9, "home", 1, "h")]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, n int")
    src = spark.createDataFrame([(2, "B1", 1), (2, "B2", 2), (3, "c", 1)], "k int, v string, n int")
    got = O.upsert(target, src, ["k"], [F.col("n").desc()])
    assert rows(got) == [(1, "a", 0), (2, "B2", 2), (3, "c", 1)]


def test_unseen(spark):
    src = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "p int, o int")
    known = spark.createDataFrame([(1, 5), (1, 900)], "p int, o int")
    assert rows(O.unseen(src, known, ["p", "o"], prune="o")) == [(1, 6), (2, 5)]
    assert rows(O.unseen(src.limit(0), known, ["p", "o"], prune="o")) == []
    plan = O.unseen(src, known, ["p", "o"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_pending_work(spark):
    teams = spark.createDataFrame([(1,), (2,)], "team int")
    done = spark.createDataFrame([(1, 2024), (1, 2024)], "team int, season int")
    assert rows(O.pending_work(teams, done, {"season": [2024, 2025]})) == [(1, 2025), (2, 2024), (2, 2025)]


def test_live_today(spark):
    import datetime as dt

    # Bangkok is 7 hours ahead: its 16th runs from 17:00 on the 15th
    data = [(1, "2025-08-15 16:59:59", "1H"), (2, "2025-08-15 17:00:00", "1H"), (3, "2025-08-16 16:59:59", "HT"), (4, "2025-08-16 10:00:00", "FT"), (5, "2025-08-16 17:00:00", "1H")]
    df = spark.createDataFrame(data, "id int, at string, s string")
    for kind in ("timestamp", "timestamp_ntz"):
        typed = df.withColumn("at", F.col("at").cast(kind))
        got = O.live_today(typed, "at", "s", dt.date(2025, 8, 16))
        assert rows(got.select("id", "feed_type")) == [(2, "live"), (3, "live")]


@pytest.mark.parametrize("seed,share", [(1, 0.0), (2, 0.1), (3, 0.4), (4, 0.9)])
def test_not_in_follows_sql(spark, seed, share):
    """Three keys with NULLs on both sides; a row stays if each target row differs in a key that neither lacks."""
    rng = random.Random(seed)

    def key():
        return tuple(None if rng.random() < share else rng.randrange(3) for _ in range(3))

    src = [(i, *key()) for i in range(60)]
    kinds = "a int, b int, c int"
    for n in (0, 1, 6):
        target = [key() for _ in range(n)]
        want = [r for r in src if all(any(x is not None and y is not None and x != y for x, y in zip(r[1:], t, strict=True)) for t in target)]
        found = O.not_in(spark.createDataFrame(src, "i int, " + kinds), spark.createDataFrame(target, kinds), ["a", "b", "c"])
        assert rows(found) == sorted(want, key=repr)


def test_not_in_is_joined_by_keys(spark):
    src, known = spark.range(5).selectExpr("id AS k"), spark.range(3).selectExpr("id AS k")
    never = O.not_in(src, known, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in never and never.count("LeftAnti") == 1  # keys without NULLs need one join
    src, known = (df.selectExpr("if(k < 9, k, null) AS k") for df in (src, known))
    plan = O.not_in(src, known, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("BroadcastNestedLoopJoin") == 2  # for one row at most
