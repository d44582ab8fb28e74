"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints that differ in at most ``distance`` bits agree on at least
``PARTS - distance`` of ``PARTS`` parts of their bits.  The upper nodes of the
index are these shared masked patterns: (mask of two parts, the pattern under
it).  Each distinct fingerprint goes to its node under every mask, and any link
lies inside one of them.  A node is sorted by Gray rank, so neighbours share
long patterns; over it stands a tree whose nodes keep only the mask bits that
their parent does not have.  A search adds up the differences on its way down
and drops a whole group once they exceed the distance.

A node of more than ``NODE_ROWS`` fingerprints is split further the same way:
its free bits are cut into ``distance + 1`` parts, one of which must agree, so
no link is lost and no task gets an unbounded node.  Nodes give spanning links,
not pairs; components come from alternating large-star and small-star rounds.
Only spanning links move: copies meet as one fingerprint, counted before any
shuffle.

Defined cases: a text without words has fingerprint zero and links like any
other; repeated rows and equal texts share a component; rows with a null doc_id
get the smallest doc_id that is not null in their component (null if none);
an empty table gives no rows; columns that are not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import read_table
from lapse.session import materialize

SHINGLE = 4
DISTANCE = 4
SEED = 42
PARTS = 6
NODE_ROWS = 100_000
LEAF = 16
FANOUT = 8
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of the word shingles: a bit is 1 if set in over half of their hashes."""
    import xxhash
    words = (text or "").encode().lower().split()       # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), HASHES_AT_ONCE):
        part = ends[at:at + HASHES_AT_ONCE]
        pieces = [joined[a:b] for a, b in zip(starts[at:at + len(part)], part)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _rid, fp): fingerprints as signed longs; the row number ``_rid`` is kept if given."""
    keep = [c for c in ("doc_id", "_rid") if c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in keep], pa.array(fps.view(np.int64))], [*keep, "fp"])

    longs = [F.col(c).cast("long").alias(c) for c in keep]
    return docs.select(*longs, "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*keep, "fp"]))


def gray_rank(fp: Column) -> Column:
    """Place of a 64-bit pattern in Gray-code order (inverse Gray code)."""
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, by))
    return fp


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def upper_masks(distance: int) -> list[int]:
    """Masks that cover ``PARTS - distance`` of the parts of 64 bits, in every choice."""
    parts = max(PARTS, distance + 2)
    cuts = [64 * i // parts for i in range(parts + 1)]
    bits = [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]
    return [_signed(sum(c)) for c in combinations(bits, parts - distance)]


def finer_masks(mask: int, distance: int) -> list[int]:
    """``mask`` with one of ``distance + 1`` parts of its free bits added, in every choice."""
    free = [i for i in range(64) if not (mask >> i) & 1]
    parts = [free[len(free) * i // (distance + 1):len(free) * (i + 1) // (distance + 1)] for i in range(distance + 1)]
    return [_signed((mask & (1 << 64) - 1) | sum(1 << i for i in p)) for p in parts if p]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of the pairs; each set is labelled by its least member."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        a, b = a[apart], b[apart]


def node_sets(fps: np.ndarray, distance: int) -> np.ndarray:
    """Set label (least index) of each fingerprint of one node, in Gray order, by its links within the node."""
    n = len(fps)
    label = np.arange(n)
    # levels from the leaves up: (first member, end, pattern, shared mask)
    first = np.arange(0, n, LEAF)
    end = np.minimum(first + LEAF, n)
    same = np.bitwise_and.reduceat(~(fps ^ np.repeat(fps[first], end - first)), first)
    levels = [(first, end, fps[first], same)]
    while len(levels[-1][0]) > 1:
        f, e, p, m = levels[-1]
        group = np.arange(0, len(f), FANOUT)
        sizes = np.diff(np.append(group, len(f)))
        differ = p ^ np.repeat(p[group], sizes)
        levels.append((f[group], e[np.append(group[1:], len(f)) - 1], p[group], np.bitwise_and.reduceat(m & ~differ, group)))
    levels.reverse()
    for at in range(0, n, 1024):
        q = np.arange(at, min(at + 1024, n))
        where, acc = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        above = None
        for depth, (f, e, p, m) in enumerate(levels):
            if depth:
                q, acc = np.repeat(q, FANOUT), np.repeat(acc, FANOUT)
                parent = np.repeat(where, FANOUT)
                where = parent * FANOUT + np.tile(np.arange(FANOUT), len(parent) // FANOUT)
                inside = where < len(f)
                q, acc, parent, where = q[inside], acc[inside], parent[inside], where[inside]
                own = m[where] & ~above[parent]
            else:
                own = m[where]
            acc = acc + popcount((fps[q] ^ p[where]) & own)
            keep = (acc <= distance) & (e[where] > q)
            q, acc, where, above = q[keep], acc[keep], where[keep], m
        first, end = levels[-1][0], levels[-1][1]
        for step in range(0, len(q), 1 << 16):      # members of the leaves that are left
            qs, ws = q[step:step + (1 << 16)], where[step:step + (1 << 16)]
            other = first[ws][:, None] + np.arange(LEAF)[None, :]
            valid = (other < end[ws][:, None]) & (other > qs[:, None])
            a = np.broadcast_to(qs[:, None], other.shape)[valid]
            b = other[valid]
            near = popcount(fps[a] ^ fps[b]) <= distance
            label = _unite(label, a[near], b[near])
    return label


def _small_sets(fps: np.ndarray, run: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within many small nodes at once: each is a single leaf; ``run`` numbers the nodes."""
    label = np.arange(len(fps))
    for d in range(1, LEAF):
        same = run[d:] == run[:-d]
        if not same.any():
            break
        a = np.flatnonzero(same)
        near = popcount(fps[a] ^ fps[a + d]) <= distance
        label = _unite(label, a[near], a[near] + d)
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def _node_links(distance: int):
    """mapInArrow function: spanning links of nodes whose rows stand together, in Gray order."""

    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) if len(fp) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fp)))
        run = np.repeat(np.arange(len(starts)), sizes)
        fps = fp.view(np.uint64)
        small = np.repeat((sizes > 1) & (sizes <= LEAF), sizes)
        found = [_small_sets(fps[small], run[small], distance)]
        for s, n in zip(starts[sizes > LEAF], sizes[sizes > LEAF]):
            label = node_sets(fps[s:s + n], distance)
            moved = label != np.arange(n)
            found.append((fps[s:s + n][moved], fps[s:s + n][label[moved]]))
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate((h, batch[c].to_numpy())) for h, c in zip(held, ("mask", "key", "fp"))]
            if not len(rows[0]):
                continue
            # the last node may go on in the next batch
            last = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held = [r[cut:] for r in rows]
            if cut:
                yield links(*[r[:cut] for r in rows])
        if len(held[0]):
            yield links(*held)

    return run


def _nodes(fps: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """(mask, key, fp): every fingerprint in its nodes; nodes above ``node_rows`` are split."""

    def under(rows: DataFrame, masks: list[int]) -> DataFrame:
        return (rows.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
                .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))

    rows, done = under(fps, upper_masks(distance)), []
    while True:
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_rows)
        sizes = materialize(sizes.select("mask", "key"), "hotnodes")
        masks = [r["mask"] for r in sizes.select("mask").distinct().collect()]     # a few masks per level
        finer = {m: f for m in masks if len(f := finer_masks(m, distance)) > distance}
        if not finer:
            break
        hot = rows.join(sizes.where(F.col("mask").isin(list(finer))), ["mask", "key"], "left_semi")
        done.append(rows.join(sizes.where(F.col("mask").isin(list(finer))), ["mask", "key"], "left_anti"))
        parts = [under(hot.where(F.col("mask") == F.lit(m)).select("fp").distinct(), f) for m, f in finer.items()]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.union(p)
        rows = materialize(rows.distinct(), "finernodes")
    for d in done:
        rows = rows.union(d)
    return rows


def near_links(fps: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that span the groups of distinct fingerprints ``fp`` within ``distance`` bits."""
    nodes = _nodes(fps, distance, node_rows)
    return (nodes.repartition("mask", "key").withColumn("rank", gray_rank(F.col("fp")))
            .sortWithinPartitions("mask", "key", "rank").drop("rank")
            .mapInArrow(_node_links(distance), "a long, b long").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it can reach.

    Large-star and small-star rounds until the links are stars; each round is
    written to the shared folder, so a lost executor costs one round.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, _rid if given, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    rows = materialize(with_fingerprint(docs, shingle), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinctfps")
    sets = components(near_links(fps.select("fp"), distance, node_rows)).withColumnRenamed("node", "fp")
    rooted = fps.join(sets, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.join(lowest, "root").select("fp", "component_id")
    return rows.join(ids, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component: the smallest doc_id, the first of repeated rows."""
    columns = docs.columns
    # written once: both uses must see the same numbers, which depend on how a scan is split
    numbered = materialize(docs.withColumn("_rid", F.monotonically_increasing_id()), "rownumbers")
    rows = near_duplicates(numbered.select("doc_id", "_rid", "text"), shingle, distance)
    # null ids come last; a component without any id keeps its first row
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_rid")
    group = F.when(F.col("component_id").isNotNull(), F.struct(F.lit(0).alias("k"), F.col("component_id").alias("v"))).otherwise(
        F.struct(F.lit(1).alias("k"), F.col("fp").alias("v")))
    first = rows.groupBy(group.alias("g")).agg(F.min(order)["_rid"].alias("_rid"))
    return numbered.join(first.select("_rid"), "_rid", "left_semi").select(*columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
