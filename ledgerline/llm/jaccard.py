"""Pairs of texts of high Jaccard similarity over five-word shingles: MinHash tables, then exact verification.

Each document has TABLES keys, each of ROWS minima of its hashed shingles. Two documents of similarity s share a key of a
table with probability s ** ROWS; at 0.8 a pair shares none of them once in 2 * 10 ** 7. Documents with equal sets of shingles
are linked to one of them, which alone goes on. Keys that one document has fall out, keys with the same documents count once, and
buckets whose members are connected already need no sets: the tables are taken in a few STEPS, and the first find most links, so
few buckets of the others remain. Before any sets are moved, a byte of each of the 128 minima tells which members of a bucket
may be similar to another of it at all. In a bucket trees are grown from member to member, each step verified by the sets, so m documents yield at most
m - 1 links.

A task holds at most LIMIT documents and WEIGHT shingles of a bucket. Buckets beyond that are worked off by rows: in each of a
few rounds every bucket names a leader, the member with most buckets, which is near the middle of a group of copies; members
that are not yet connected to it are compared with it, and buckets whose members are all connected are done. What remains is
dealt out again by TABLES further keys, and if a bucket is still too large, by blocks of members: those not connected to the
leader against all. Only comparisons that can change nothing are left out, so nothing is capped.

Words are split at white space and lower-cased; a text of fewer than SHINGLE words is one shingle. A null text and one without
words have none and are linked to nothing. Rows that share a doc_id count as one document; rows without one are left out.
The tables are laid out for similarities of 0.8 and more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import keyed, per_worker, slices, small, stored, tidied

SHINGLE, SIMILARITY, TABLES, ROWS, SEED, CHUNK = 5, 0.8, 32, 4, 42, 512
LIMIT, WEIGHT, ROUNDS, STEPS, AGREE = 4096, 1 << 22, 3, (0, 8, TABLES), 72


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of the distinct shingles, ascending."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate(([0], spaces + 1)), np.append(spaces, len(joined))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())], np.uint64))


def _factors(level: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, level))
    return rng.integers(0, 1 << 63, (TABLES * ROWS, 1), np.uint64), rng.integers(0, 1 << 63, (TABLES * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def minima(own: np.ndarray, level: int = 0) -> np.ndarray:
    """TABLES times ROWS minima of the hashes of at least one shingle."""
    added, factors = per_worker(("minhash", level), lambda: _factors(level))
    least = None
    for at in range(0, len(own), CHUNK):
        mixed = (own[at : at + CHUNK] ^ added) * factors
        mixed ^= mixed >> np.uint64(32)
        now = mixed.min(axis=1)
        least = now if least is None else np.minimum(least, now)
    return least


def table_keys(least: np.ndarray) -> np.ndarray:
    """The key of each table."""
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), SEED) for row in least.reshape(TABLES, ROWS)], np.uint64).view(np.int64)


def _signer(shingle: int):
    """doc_id, text in; the digest and size of its set, the keys, and a byte of each minimum, out. Texts without words are left
    out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(t, shingle) for t in part.column(1).to_pylist()]
            least = [minima(s) if len(s) else None for s in sets]
            keys = pa.array([None if m is None else table_keys(m) for m in least], pa.list_(pa.int64()))
            sketches = pa.array([None if m is None else m.astype(np.uint8).tobytes() for m in least], pa.binary())
            digests = pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary())
            out = pa.RecordBatch.from_arrays([part.column(0), digests, pa.array([len(s) for s in sets], pa.int64()), keys, sketches], ["doc_id", "digest", "size", "keys", "sketch"])
            yield out.filter(pa.array([len(s) > 0 for s in sets], pa.bool_()))

    return run


def _setter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(t, shingle).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["doc_id", "own"])

    return run


def _resigner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        keys = [table_keys(minima(np.frombuffer(x, np.uint64), 1)) for x in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "keys"])


def near(own: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of the others whether it is that similar."""
    sizes = np.array([len(s) for s in others])
    out = (sizes >= similarity * len(own) * (1 - 1e-9)) & (sizes * similarity * (1 - 1e-9) <= len(own))
    fits = np.flatnonzero(out)
    if fits.size:
        joined = np.concatenate([others[k] for k in fits.tolist()])
        hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
        both = np.add.reduceat(hit, np.concatenate(([0], np.cumsum(sizes[fits])[:-1])), dtype=np.int64)
        out[fits] = both / (sizes[fits] + len(own) - both) >= similarity
    return out


def trees(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Links that connect what is linked among these sets: each is compared with those not reached so far."""
    left = np.arange(len(sets))
    while left.size:
        front, left = [int(left[0])], left[1:]
        while front and left.size:
            at = front.pop()
            reached = near(sets[at], [sets[k] for k in left.tolist()], similarity)
            yield from ((at, k) for k in left[reached].tolist())
            front.extend(left[reached].tolist())
            left = left[~reached]


def alike(sketches: np.ndarray, least: int) -> np.ndarray:
    """For each row of bytes whether another agrees with it in so many places."""
    out = np.zeros(len(sketches), bool)
    for k in range(len(sketches) - 1):
        hits = (sketches[k + 1 :] == sketches[k]).sum(axis=1, dtype=np.int32) >= least
        out[k] |= hits.any()
        out[k + 1 :] |= hits
    return out


def _sifter(least: int):
    """Over rows (bucket, doc_id, sketch) sorted by bucket: those that some other of the bucket may be similar to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in _with_end(batches):
            table = kept if batch is None else batch if kept is None else pa.concat_batches([kept, batch])
            if table is None or not table.num_rows:
                kept = table
                continue
            buckets = table.column(0).to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]))
            whole = len(starts) - 1 if batch is None else len(starts) - 2  # the last bucket may go on in the next batch
            data = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(buckets), -1)
            keep = np.zeros(len(buckets), bool)
            for a, b in zip(starts[:whole].tolist(), starts[1 : whole + 1].tolist()):
                keep[a:b] = alike(data[a:b], least)
            yield pa.RecordBatch.from_arrays([table.column(0), table.column(1)], ["bucket", "doc_id"]).filter(pa.array(keep))
            kept = table.slice(int(starts[whole]))

    return run


def _sifted(members: DataFrame, signed: DataFrame, kind: str, limit: int, weight: int) -> DataFrame:
    """members without those of buckets within the limit whose sketch agrees with no other there in AGREE places.

    Similar documents agree in a place with their similarity as the probability, or a 256th more: a pair at 0.8 misses AGREE of
    the 128 places once in 10 ** 10. What shares no more than a passage is left out before any set is moved.
    """
    fits = members.where(_fits(limit, weight))
    sketches = signed.select("doc_id", "sketch").dropDuplicates(["doc_id"])
    dealt = fits.select("bucket", "doc_id").join(sketches, "doc_id").repartition("bucket").sortWithinPartitions("bucket").select("bucket", "doc_id", "sketch")
    kept = stored(dealt.mapInArrow(tidied(_sifter(AGREE)), f"bucket bigint, doc_id {kind}").distinct(), "sifted")
    return stored(members.join(kept, ["bucket", "doc_id"]).unionByName(members.where(~_fits(limit, weight))), "members")


def _linker(similarity: float):
    """Over rows (group, side, doc_id, own) sorted by group: links of each group. Side 0 among themselves; if a group has sides
    1 and 2, those of side 1 against those of side 2."""

    def out(sides: list[int], nodes: list, own: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(x, np.uint64) for x in own]
        if sides and sides[0]:
            right = [k for k, s in enumerate(sides) if s == 2]
            others = [sets[k] for k in right]
            found = [(a, right[b]) for a, s in enumerate(sides) if s == 1 and right for b in np.flatnonzero(near(sets[a], others, similarity)).tolist()]
        else:
            found = list(trees(sets, similarity))
        pairs = [(nodes[a], nodes[b]) for a, b in found if nodes[a] != nodes[b]]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x in zip(*pairs)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sides, nodes, own, kind = None, [], [], [], pa.int64()
        for batch in batches:
            kind = batch.column(2).type
            for g, side, node, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if g != group:
                    yield from out(sides, nodes, own, kind)
                    group, sides, nodes, own = g, [], [], []
                sides.append(side)
                nodes.append(node)
                own.append(data)
        yield from out(sides, nodes, own, kind)

    return run


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _verify(pairs: DataFrame, sets: DataFrame, similarity: float, kind: str) -> DataFrame:
    """pairs (leader, doc_id): those that are similar, as links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            keep = [bool(near(np.frombuffer(a, np.uint64), [np.frombuffer(b, np.uint64)], similarity)[0]) for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    leads = sets.join(pairs.select(F.col("leader").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("leader"), F.col("own").alias("lead"))
    return pairs.join(sets, "doc_id").join(small(leads), "leader").select("leader", "doc_id", "lead", "own").mapInArrow(tidied(run), f"a {kind}, b {kind}")


def _buckets(keys: DataFrame, name: str) -> DataFrame:
    """bucket, n, weight, doc_id, size of the members of buckets with two documents or more, of equal buckets one. keys: bucket,
    doc_id, size."""
    of = keys.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("doc_id").alias("least"), F.expr("bit_xor(xxhash64(doc_id))").alias("x"), F.sum(F.expr("xxhash64(doc_id, 7) % 1000003")).alias("y")).where("n > 1")
    once = stored(of.groupBy("n", "weight", "least", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "weight"), name)
    return stored(keys.join(small(once), "bucket"), f"{name}_members")


def _within(members: DataFrame, sets: DataFrame, similarity: float, kind: str) -> DataFrame:
    """Links of buckets that fit into a task."""
    dealt = members.join(sets, "doc_id").repartition("bucket").sortWithinPartitions("bucket").select("bucket", F.lit(0).alias("side"), "doc_id", "own")
    return dealt.mapInArrow(tidied(_linker(similarity)), f"a {kind}, b {kind}").distinct()


def _connected(members: DataFrame, links: DataFrame) -> DataFrame:
    """members with root, of buckets that are not yet connected."""
    from .simhash import components

    roots = components(links)
    cur = members.drop("root").join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    open_ = cur.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z").select("bucket")
    return stored(cur.join(open_, "bucket", "left_semi"), "open")


def _lead(members: DataFrame, links: DataFrame, sets: DataFrame, similarity: float, kind: str, rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members of buckets that stay open after all rounds, the last leaders (bucket, lead_root), and all links."""
    rank = F.struct("held", F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("d"))
    held = members.groupBy("doc_id").agg(F.count("*").alias("held"))
    now = _connected(members.join(held, "doc_id"), links)
    before: DataFrame | None = None
    leaders = None
    for _ in range(rounds):
        if now.isEmpty():
            break
        able = now if before is None else now.join(small(before), "bucket").where(rank < F.col("last")).drop("last")
        leaders = stored(able.groupBy("bucket").agg(F.max(rank).alias("last"), F.max_by("root", rank).alias("lead_root")), "leaders")
        before = leaders.select("bucket", "last")
        pairs = now.join(small(leaders), "bucket").where("root <> lead_root").select(F.col("last.d").alias("leader"), "doc_id").distinct()
        links = stored(links.unionByName(_verify(stored(pairs, "pairs"), sets, similarity, kind)).distinct(), "links")
        now = _connected(members.join(held, "doc_id"), links)
    return now, leaders, links


def _blocks(now: DataFrame, leaders: DataFrame, sets: DataFrame, similarity: float, kind: str, limit: int, weight: int) -> DataFrame:
    """Links of members that are not connected to the leader, against all members, in blocks that fit into a task."""
    cur = now.join(small(leaders.select("bucket", "lead_root")), "bucket")
    apart = F.col("root") != F.col("lead_root")
    blocks = lambda n, w: F.greatest(F.ceil(n / limit), F.ceil(w / weight), F.lit(1)).cast("int")
    sizes = cur.groupBy("bucket").agg(blocks(F.count("*"), F.sum("size")).alias("all"), blocks(F.count_if(apart), F.coalesce(F.sum(F.when(apart, F.col("size"))), F.lit(0))).alias("some"))
    each = cur.join(small(sizes), "bucket")
    of = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = each.where(apart).select("bucket", of(F.col("some")).alias("i"), to("all").alias("j"), F.lit(1).alias("side"), "doc_id")
    right = each.select("bucket", to("some").alias("i"), of(F.col("all")).alias("j"), F.lit(2).alias("side"), "doc_id")
    rows = left.unionByName(right).withColumn("group", F.struct("bucket", "i", "j")).join(sets, "doc_id")
    dealt = rows.repartition("group").sortWithinPartitions("group").select(F.concat_ws(" ", "bucket", "i", "j").alias("g"), "side", "doc_id", "own")
    return dealt.mapInArrow(tidied(_linker(similarity)), f"a {kind}, b {kind}").distinct()


def _fits(limit: int, weight: int) -> Column:
    return (F.col("n") <= limit) & (F.col("weight") <= weight)


def _linked(members: DataFrame, found: DataFrame, named: DataFrame, similarity: float, shingle: int, kind: str, limit: int, weight: int, rounds: int) -> DataFrame:
    """found and the links of these members' buckets."""
    sets = stored(keyed(named, members, "left_semi").mapInArrow(tidied(_setter(shingle)), f"doc_id {kind}, own binary").where("length(own) > 0"), "sets")
    found = stored(found.unionByName(_within(members.where(_fits(limit, weight)), sets, similarity, kind)), "found")
    over = members.where(~_fits(limit, weight)).select("bucket", "doc_id", "size")
    if over.isEmpty():
        return found
    now, leaders, found = _lead(over, found, sets, similarity, kind, rounds)
    if now.isEmpty():
        return found
    more = sets.join(now.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(tidied(_resigner), f"doc_id {kind}, keys array<bigint>")
    dealt = now.select("bucket", "doc_id", "size").join(more.select("doc_id", F.posexplode("keys").alias("t", "key")), "doc_id")
    again = _buckets(dealt.select(F.xxhash64("bucket", "t", "key").alias("bucket"), "doc_id", "size").distinct(), "again")
    found = stored(found.unionByName(_within(again.where(_fits(limit, weight)), sets, similarity, kind)), "found")
    rest = again.where(~_fits(limit, weight)).select("bucket", "doc_id", "size")
    if rest.isEmpty():
        return found
    now, leaders, found = _lead(rest, found, sets, similarity, kind, rounds)
    return found if now.isEmpty() else stored(found.unionByName(_blocks(now, leaders, sets, similarity, kind, limit, weight)), "found")


def links(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, known: DataFrame | None = None, limit: int = LIMIT, weight: int = WEIGHT, rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) between doc_ids that connect the documents of at least that similarity, beside those known, which are
    among them. The tables are laid out for SIMILARITY and more; below it they would miss too many pairs, so that is refused."""
    if similarity < SIMILARITY:
        raise ValueError(f"similarity {similarity} is below {SIMILARITY}, for which the MinHash tables are laid out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    signed = stored(named.mapInArrow(tidied(_signer(shingle)), f"doc_id {kind}, digest binary, size bigint, keys array<bigint>, sketch binary"), "minima")
    first = signed.groupBy("digest").agg(F.min("doc_id").alias("b"), F.count("*").alias("n"))
    equal = signed.join(first.where("n > 1"), "digest").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    found = stored(equal if known is None else equal.unionByName(known.select("a", "b")), "found")
    alone = signed.join(first.select("digest", F.col("b").alias("doc_id")), ["digest", "doc_id"]).dropDuplicates(["digest"])
    once = stored(alone.select("doc_id", "size", "keys"), "singles")
    for a, b in zip(STEPS, STEPS[1:]):  # a few tables find most links, so most buckets of the others are done
        keys = F.posexplode(F.slice("keys", a + 1, b - a)).alias("t", "key")
        own = once.select("doc_id", "size", keys).select(F.xxhash64(F.col("t") + a, "key").alias("bucket"), "doc_id", "size")
        members = _connected(_sifted(_buckets(own, "buckets"), signed, kind, limit, weight), found)
        if not members.isEmpty():
            found = _linked(members, found, named, similarity, shingle, kind, limit, weight, rounds)
    return found
