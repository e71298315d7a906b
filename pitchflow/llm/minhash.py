"""Near duplicates by MinHash with tensored banding, confirmed on whole shingle sets.

Two collections of `SKETCHES` small sketches (of `HASHES` minhashes each) are kept per document, and each table
key is a pair of one sketch from either: 32 sketches make 256 tables of six minhashes each. Documents of similarity s
share a key with probability (1 - (1 - s ** HASHES) ** SKETCHES) ** 2: at 0.8, two different texts are missed with
probability 2e-5, at 0.85 with 5e-7, and a missed link splits a component only if no other path joins it.

No pair of documents is a row unless one of them may be linked with what it is held against. Equal sets are one node. A node is first
compared with one other alone, the smallest hub (smallest node of a table key) it meets; then with the hubs of its other
keys that are still in another component. What is then in another component than one of its hubs is held against all that meet that
hub: tasks have bounded blocks of either side, first with the codes of some minhashes and then, for the nodes left, with their
whole sets, and return links only. No member is left out for its distance to the hub: chains may reach it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import dropped, small_batches, staged, text_steps, texts_of
from pitchflow.llm.components import connected_components

SKETCHES = 16
HASHES = 3
#: Of the first minhashes, 16 to a code, four bits each are kept: CODES long columns.
CODES = ("code0", "code1", "code2")
#: So many of the 48 differ at most if two documents may be linked (more do with 2e-5 at similarity 0.8).
LINK_CODES = 21
#: Shingles in a block of nodes that a task holds against another block (one document at least).
BLOCK_SHINGLES = 400_000

_SEEDS = np.random.default_rng(20240517).integers(1, 2**63, (2 * SKETCHES * HASHES, 2), np.uint64) | np.uint64(1)
_FOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles: A-Z lower-cased, words split at ASCII white space;
    with fewer words than `size` all of them are one shingle, without words the set is empty."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    folded = hashes[: len(hashes) - size + 1]
    for at in range(1, size):
        folded = _mixed(folded * _FOLD) + hashes[at : len(hashes) - size + 1 + at]
    return np.unique(_mixed(folded))


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of non-empty sets: the sketches, first those of one collection, then of the other, and the codes."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    flat = np.concatenate(sets)
    codes = np.zeros((len(sets), len(CODES)), np.uint64)
    out = np.zeros((len(sets), 2 * SKETCHES), np.uint64)
    for k, (add, factor) in enumerate(_SEEDS):
        least = np.minimum.reduceat(_mixed((flat ^ add) * factor), starts)
        if k < 16 * len(CODES):
            codes[:, k // 16] |= (_mixed(least * _FOLD) >> np.uint64(60)) << np.uint64(4 * (k % 16))
        out[:, k // HASHES] = _mixed(out[:, k // HASHES] * _FOLD + least)
    return out.view(np.int64), codes.view(np.int64)


def _sketch_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            sets = [shingle_set(t, size) for t in texts_of(batch)]
            some = [s for s in sets if len(s)]
            found, codes = sketches(some) if some else (np.zeros((0, 2 * SKETCHES), np.int64), np.zeros((0, len(CODES)), np.int64))
            at = np.cumsum([0, *(len(s) > 0 for s in sets)])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_id": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    **{name: pa.array([int(codes[at[i], k]) if len(s) else None for i, s in enumerate(sets)], pa.int64()) for k, name in enumerate(CODES)},
                    "sketches": pa.array([found[at[i]] if len(s) else None for i, s in enumerate(sets)], pa.list_(pa.int64())),
                }
            )

    return rows


def _set_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            sets = [shingle_set(t, size).view(np.int64) for t in texts_of(batch)]
            yield pa.RecordBatch.from_pydict({"node": batch.column("doc_id"), "set": pa.array(sets, pa.list_(pa.int64()))})

    return rows


def _differing(a: str, b: str) -> Column:
    """Number of codes that differ: groups of four bits with any difference."""
    total = F.lit(0)
    for code in CODES:
        x = F.col(f"{a}.{code}").bitwiseXOR(F.col(f"{b}.{code}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _plausible(a: str, b: str, percent: int) -> Column:
    """Sizes and codes allow a similarity of `percent` in 100."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (_differing(a, b) <= LINK_CODES)


def _sets(nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, set) of the documents whose doc_id is in `nodes`."""
    texts = docs.join(nodes.distinct(), "doc_id", "left_semi").select("doc_id", "text")
    return staged(texts.mapInArrow(_set_rows(size), "node long, set array<long>"), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * |intersection| >= percent * |union|."""
    pairs = staged(pairs, "pairs")
    sets = _sets(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs, size)
    a, b = (sets.select(F.col("node").alias(k), F.col("set").alias(f"set_{k}")) for k in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
    linked = F.col("shared") * 100 >= (F.size("set_a") + F.size("set_b") - F.col("shared")) * percent
    links = staged(both.filter(linked).select("a", "b").distinct(), "links")
    dropped(pairs, sets)
    return links


def _met_hubs(nodes: DataFrame) -> DataFrame:
    """(hub, node): the smallest node of each table key that several nodes share, and the others that share it.

    A node can only share a key if it shares a sketch of either collection, so keys are formed from
    shared sketches alone.
    """
    each = nodes.select("node", F.posexplode("sketches").alias("place", "sketch"))
    common = each.groupBy("place", "sketch").count().filter("count > 1").select("place", "sketch")
    kept = each.join(common, ["place", "sketch"])
    sides = kept.groupBy("node").agg(
        *(
            F.collect_list(F.when(which, F.struct("place", "sketch"))).alias(side)
            for side, which in (("first", F.col("place") < SKETCHES), ("second", F.col("place") >= SKETCHES))
        )
    )
    keys = sides.select("node", F.explode("first").alias("x"), "second").select("node", "x", F.explode("second").alias("y"))
    keys = staged(keys.select(F.xxhash64("x", "y").alias("key"), "node"), "table_keys")
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    met = keys.join(hubs.drop("members"), "key").filter("node <> hub").select("hub", "node").distinct()
    met = staged(met, "met_hubs")
    dropped(keys)
    return met


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of codes that differ, of each row of `a` and each of `b`."""
    out = np.zeros((len(a), len(b)), np.uint8)
    ones = np.uint64(0x1111111111111111)
    for k in range(a.shape[1]):
        x = a[:, k, None] ^ b[None, :, k]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        out += np.bitwise_count(x & ones)
    return out


def _codes_of(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().view(np.uint64) for c in CODES], 1)


def _apart(mine: pa.Table, others: pa.Table) -> np.ndarray:
    """Which pairs are of different components; of two nodes that are both odd, only the one way round."""
    node, component = (mine.column(c).to_numpy()[:, None] for c in ("node", "component"))
    right = component != others.column("component").to_numpy()[None, :]
    return right & (~others.column("odd").to_numpy(zero_copy_only=False)[None, :] | (node < others.column("node").to_numpy()[None, :]))


def _possible(percent: int):
    """Nodes of two blocks, odd ones and any, that may be linked with one of the other block by size and codes."""

    def rows(mine: pa.Table, others: pa.Table) -> pa.Table:
        n, m = mine.column("n").to_numpy()[:, None], others.column("n").to_numpy()[None, :]
        found = [np.zeros(0, np.int64)]
        for at in range(0, mine.num_rows, 256):
            some = mine.slice(at, 256)
            near = _apart(some, others) & (_differ(_codes_of(some), _codes_of(others)) <= LINK_CODES)
            near &= np.minimum(n[at : at + 256], m) * 100 >= np.maximum(n[at : at + 256], m) * percent
            found += [some.column("node").to_numpy()[near.any(1)], others.column("node").to_numpy()[near.any(0)]]
        nodes = np.unique(np.concatenate(found))
        hub = (mine if mine.num_rows else others).column("hub")[0].as_py()
        return pa.Table.from_arrays([pa.array([hub] * len(nodes), pa.int64()), pa.array(nodes)], names=["hub", "node"])

    return rows


def _linked_blocks(percent: int):
    """Links (a, b) of two blocks by their whole sets: of each odd node, one with each other component."""

    def rows(mine: pa.Table, others: pa.Table) -> pa.Table:
        ends: list[tuple[int, int]] = []
        if mine.num_rows and others.num_rows:
            sets = others.column("set").combine_chunks()
            flat, starts = sets.flatten().to_numpy(), sets.offsets.to_numpy()[:-1] - sets.offsets.to_numpy()[0]
            tokens, flat = np.unique(flat, return_inverse=True)
            m = np.diff(sets.offsets.to_numpy())
            nodes, components = others.column("node").to_numpy(), others.column("component").to_numpy()
            apart = _apart(mine, others)
            own = mine.column("set").combine_chunks()
            for k, node in enumerate(mine.column("node").to_pylist()):
                tokens_of = own[k].values.to_numpy()
                at = np.minimum(np.searchsorted(tokens, tokens_of), len(tokens) - 1)
                marked = np.zeros(len(tokens), np.int32)
                marked[at[tokens[at] == tokens_of]] = 1
                shared = np.add.reduceat(marked[flat], starts).astype(np.int64)
                linked = np.flatnonzero(apart[k] & (shared * 100 >= (len(tokens_of) + m - shared) * percent))
                one = linked[np.unique(components[linked], return_index=True)[1]]
                ends += [(min(node, x), max(node, x)) for x in nodes[one].tolist()]
        a, b = zip(*ends, strict=True) if ends else ((), ())
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows


def _in_blocks(members: DataFrame, columns: tuple[str, ...], sizes: DataFrame, compare, kinds: str) -> DataFrame:
    """Hold each hub's odd members against all of its members, both dealt into the blocks of `sizes` (hub, odd_blocks, blocks)."""
    dealt = members.join(sizes, "hub")
    place = F.xxhash64("node")
    mine = dealt.filter("odd").select("hub", F.pmod(place, "odd_blocks").alias("i"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("j"), *columns)
    others = dealt.select("hub", F.explode(F.expr("sequence(0, odd_blocks - 1)")).alias("i"), F.pmod(place, "blocks").alias("j"), *columns)
    # new names for the columns of one side: both come from one table
    others = others.select(*(F.col(c).alias(c) for c in others.columns))
    return mine.groupBy("hub", "i", "j").cogroup(others.groupBy("hub", "i", "j")).applyInArrow(compare, kinds)


def _sizes(members: DataFrame) -> DataFrame:
    """(hub, odd_blocks, blocks) of hubs with odd members, by the shingles of either kind."""
    blocks = [F.ceil(F.sum(x) / BLOCK_SHINGLES).alias(name) for name, x in (("odd_blocks", F.when(F.col("odd"), F.col("n"))), ("blocks", F.col("n")))]
    return members.groupBy("hub").agg(*blocks).filter("odd_blocks > 0")


def _placed(rows: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """Rows with the component of a node column so far, itself where it has no link."""
    known = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row: documents are linked if their sets of `size`-word shingles
    have a Jaccard similarity of `percent` in 100 or more, and component_id is the smallest doc_id reachable.

    NULL and empty texts and texts without words have n_shingles 0 and are linked with nothing. Rows with a NULL
    doc_id are linked with nothing either (component_id NULL, kept). Equal rows get equal results; different
    texts under one doc_id count as one document where they meet. Other columns are left out.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = f"doc_id long, n_shingles long, set_id binary, {' long, '.join(CODES)} long, sketches array<long>"
    rows = staged(docs.mapInArrow(_sketch_rows(size), kinds), "sketches")
    some = rows.filter("n_shingles > 0 and doc_id is not null")
    nodes = staged(
        some.groupBy("set_id").agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            *(F.first(c).alias(c) for c in CODES),
            F.first("sketches").alias("sketches"),
        ),
        "nodes",
    )
    met = _met_hubs(nodes)
    small = nodes.select("node", "n", *CODES)

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), each once, those that the whole sets confirm."""
        both = pairs.join(small.alias("x"), F.col("a") == F.col("x.node")).join(small.alias("y"), F.col("b") == F.col("y.node"))
        return _confirmed(both.filter(_plausible("x", "y", percent)).select("a", "b"), docs, size, percent)

    # every node against the smallest hub it meets
    by_hub = met.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = linked(by_hub.groupBy("b").agg(F.min("a").alias("a")))
    found = connected_components(links)

    # against the other hubs, where they are not joined yet
    others = _placed(_placed(by_hub, found, "a", "component_a"), found, "b", "component_b").filter("component_a <> component_b")
    links = links.union(linked(others.select("a", "b")))
    found = connected_components(links)

    # what is not in a hub's component, against all that meet the hub
    every = met.union(met.select("hub", F.col("hub").alias("node")).distinct())
    placed = _placed(_placed(every, found, "node", "component"), found, "hub", "hub_component")
    placed = placed.withColumn("odd", F.col("component") != F.col("hub_component")).join(small, "node")
    unsettled = placed.filter("odd").select("hub").distinct()
    members = staged(placed.join(unsettled, "hub", "left_semi").select("hub", "node", "component", "odd", "n", *CODES), "hub_members")
    columns = ("node", "component", "odd", "n")
    possible = _in_blocks(members, (*columns, *CODES), _sizes(members), _possible(percent), "hub long, node long")
    left = staged(members.join(possible.distinct(), ["hub", "node"], "left_semi").select("hub", *columns), "left_members")
    sets = _sets(left.select(F.col("node").alias("doc_id")), docs, size)
    rest = _in_blocks(left.join(sets, "node"), (*columns, "set"), _sizes(left), _linked_blocks(percent), "a long, b long")
    rest = staged(rest.distinct(), "links")
    dropped(met, members, left, sets)
    components = connected_components(links.union(rest)) if rest.take(1) else found

    by_set = nodes.select("set_id", "node").join(components, "node", "left")
    by_set = by_set.select("set_id", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
