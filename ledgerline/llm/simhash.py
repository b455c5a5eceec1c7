"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bit positions gets a non-zero vector of F_2^4. For each of the 15 non-zero v, a mask holds the positions
whose vector has an odd product with v. Positions where two fingerprints differ span at most three dimensions when there
are at most three of them, so some v is orthogonal to all: under its mask both are equal. Every pair within the radius
therefore meets in a table; no candidate is left to chance.

Links are found inside a bucket by growing trees from member to member, so a bucket of m fingerprints yields at most m - 1
links and never its pairs. A bucket over BUCKET members is dealt out again under covering masks of its free bits; what then
still agrees leaves 14 to 17 free bits, which bounds the second bucket by their combinations. Components come from
alternating large and small stars over these links, all of it distributed.

Nulls: a null text is empty; the fingerprint of a text without words is zero, and zero links like any other. Rows that share
a doc_id count as one document. An empty table gives no rows. A document without a doc_id links others like any other and
has their component; the component of such documents alone is null. Ids may be of any type that has an order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, passing, per_worker, raw, slices, stored, tidied

RADIUS, SHINGLE, SEED, BUCKET = 3, 3, 42, 4096


def _lanes() -> np.ndarray:
    """For each byte, its eight bits in the eight bytes of a word: sums of up to 255 rows do not overflow."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return bits.copy().view(np.uint64).ravel()


def fingerprint(text: bytes, lanes: np.ndarray) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        found = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        found = [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())]
    spread = lanes[np.array(found, np.uint64).view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(spread, np.arange(0, len(found), 255), axis=0)
    counts = sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lanes = per_worker(("simhash",), _lanes)
    for part in slices(batches):
        got = np.array([fingerprint(t, lanes) for t in raw(part.column(1))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got)], ["doc_id", "fp"])


def covering_masks(positions: list[int]) -> list[int]:
    """The 15 masks over these bit positions that cover radius 3."""
    vectors = {p: 1 + k % 15 for k, p in enumerate(positions)}
    return [sum(1 << p for p, u in vectors.items() if (u & v).bit_count() % 2) for v in range(1, 16)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


MASKS = covering_masks(list(range(64)))
SECOND = [[m | s for s in covering_masks([p for p in range(64) if not m >> p & 1])] for m in MASKS]


def _trees(fp: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked in this bucket: each member is compared with those not reached so far."""
    left = np.arange(len(fp))
    while left.size:
        front, left = [left[0]], left[1:]
        while front and left.size:
            at = front.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= RADIUS
            if near.any():
                reached, left = left[near], left[~near]
                yield np.full(len(reached), node[at]), node[reached]
                front.extend(reached.tolist())


def _linker(limit: int | None):
    """Over rows sorted by table and key: links (over = false), or with over = true the rows of buckets beyond limit."""

    def out(over: bool, a: np.ndarray, b: np.ndarray, table: np.ndarray | int) -> pa.RecordBatch:
        n = len(a)
        tables = np.broadcast_to(np.asarray(table, np.int32), n)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, over)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(tables)], ["over", "a", "b", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, passing = None, None
        for batch in _with_end(batches):
            last = batch is None
            if not last:
                now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
                now = [x.copy() for x in now] if kept is None else [np.concatenate(x) for x in zip(kept, now)]
            elif kept is None:
                return
            else:
                now = kept
            t, key, fp, node = now
            if passing is not None:  # the rest of a bucket that is over the limit
                same = (t == passing[0]) & (key == passing[1])
                n = len(t) if same.all() else int(np.argmin(same))
                if n:
                    yield out(True, fp[:n], node[:n], t[:n])
                t, key, fp, node = t[n:], key[n:], fp[n:], node[n:]
                if not len(t):
                    kept = None
                    continue
                passing = None
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate(([0], cuts))
            ends = np.concatenate((cuts, [len(t)]))
            if not last:  # the last bucket may go on in the next batch
                keep = starts[-1]
                starts, ends = starts[:-1], ends[:-1]
            sizes = ends - starts
            two = starts[sizes == 2]
            near = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= RADIUS]
            if len(near):
                yield out(False, node[near], node[near + 1], 0)
            for a, b in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
                if limit and b - a > limit:
                    yield out(True, fp[a:b], node[a:b], t[a:b])
                    continue
                links = list(_trees(fp[a:b].view(np.uint64), node[a:b]))
                if links:
                    yield out(False, *(np.concatenate(x) for x in zip(*links)), 0)
            if not last:
                kept = [x[keep:] for x in (t, key, fp, node)]
                if limit and len(kept[0]) > limit:
                    passing = (kept[0][0], kept[1][0])
                    yield out(True, kept[2], kept[3], kept[0])
                    kept = None

    return run


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


_LINKS = "over boolean, a bigint, b bigint, t int"


def _linked(keys: DataFrame, limit: int | None) -> DataFrame:
    dealt = keys.repartition("t", "key").sortWithinPartitions("t", "key").select("t", "key", "fp", "node")
    return dealt.mapInArrow(tidied(_linker(limit)), _LINKS)


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """nodes: fp, node (distinct fingerprints and their names). Links (a, b) between nodes that connect what is within reach."""
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(MASKS)]))
    first = stored(_linked(nodes.select("fp", "node", tables.alias("x")).select("x.t", "x.key", "fp", "node"), bucket), "links")
    found = first.where("NOT over").select("a", "b")
    over = first.where("over").select("t", F.col("a").alias("fp"), F.col("b").alias("node"))
    if over.isEmpty():
        return found.distinct()
    masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in SECOND])
    again = over.select("fp", "node", "t", F.posexplode(masks[F.col("t")]).alias("v", "mask"))
    keys = again.select((F.col("t") * 15 + F.col("v")).cast("int").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "node")
    return found.unionByName(_linked(keys, None).select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of an edge that is not itself the smallest of its component, that smallest node.

    Alternating large and small stars; each round is written to the shared folder, and the loop ends when a round changes
    nothing. Minima are combined before the shuffle, so a node with very many edges costs one row from each task.
    """
    spark = edges.sparkSession

    def star(both: DataFrame, keep) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), least

    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = star(both, F.col("v") > F.col("u"))
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        small, least = star(large, F.lit(True))
        before, now = now, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
        discard(spark, before)
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("xxhash64(v, u) % 1000003"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    with passing(docs.sparkSession) as keep:
        fps = stored(docs.select("doc_id", "text").mapInArrow(tidied(_fingerprints), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint"), "fingerprints")
        nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
        roots = components(links(nodes.select("fp", F.col("fp").alias("node")), bucket))
        rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        of = stored(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id"), "components")
        keep(fps, of)
    return fps.join(of, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, similarity: float | None = None, shingle: int = 5, bucket: int = BUCKET, **options) -> DataFrame:
    """docs with one document of each group of near-duplicates: that with the smallest doc_id, all its columns as they were.

    Groups are those of op2. With a similarity, pairs of at least that Jaccard similarity over shingles of so many words are
    linked as well, which fingerprints within RADIUS bits mostly miss (see jaccard.py, to which options go). A document without
    a doc_id stays. Rows that share a doc_id stay or go together.
    """
    from . import jaccard
    from .base import keyed

    with passing(docs.sparkSession) as keep:
        groups = near_duplicates(docs, bucket).where("doc_id <> component_id")
        if similarity is not None:
            known = stored(groups.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")), "near_links")
            groups = components(jaccard.links(docs, shingle, similarity, known, **options)).select(F.col("node").alias("doc_id"))
        gone = stored(groups.select("doc_id"), "near")
        keep(gone)
    return keyed(docs, gone, "left_anti")
