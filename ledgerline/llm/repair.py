"""Token ids in files compressed by Re-Pair grammars.

Documents are dealt by ranges of doc_id and sorted, encoded, and cut into shards of about SHARD ids, whole documents each.
In a shard, frequent pairs of neighbouring symbols within a document are replaced by nonterminals, in rounds: a round counts
all pairs, gives a rule to each of the most frequent, and replaces their occurrences from left to right. Rounds end when no
pair occurs LEAST times, so the rules of a round together expand to a sixteenth of the shard at most. The file of a shard
holds the rules, the expansion length of each, the remaining symbols and, for each document, where its symbols end. A
document, or a range of its ids, is decoded without touching the rest of the shard.

Shards are the binary column of a Parquet table in the shared folder, written by Spark's committer: a lost executor leaves
no half-written shard.

A null text is empty; every document ends with the id END, so an empty one has one id. A null doc_id comes first. Rows that
repeat a doc_id are documents of their own, in the order of a hash of their texts; they are dealt by it too, and equal rows by
their place, so an id that a third of the rows share fills no one task. An empty table gives an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import body, per_worker, scratch, sized, slices, tidied
from .tokens import Encoder, public_path

END, SHARD, RULES, LEAST, BATCH = 0, 1 << 19, 4096, 16, 4 << 20
MAGIC = 0x31475052
_BUCKETS = 1 << 18


def _pair_buckets(s: np.ndarray) -> np.ndarray:
    mixed = s[:-1] * np.uint32(0x9E3779B1) ^ s[1:] * np.uint32(0x85EBCA6B)
    return (mixed ^ mixed >> np.uint32(15)) & np.uint32(_BUCKETS - 1)


def compress(ids: np.ndarray, lengths: np.ndarray, base: int, rules: int = RULES, least: int = LEAST) -> bytes:
    """The file of one shard: ids of its documents one after another, the length of each, the first nonterminal.

    rules: how many a round makes at least, where so many pairs are frequent; an eighth of them if that is more.
    """
    s = ids.astype(np.uint32)
    last = np.zeros(len(s), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    grammar = np.zeros((0, 2), np.uint32)
    while len(s) > 1:
        buckets = _pair_buckets(s)
        buckets[last[:-1]] = _BUCKETS
        counts = np.bincount(buckets, minlength=_BUCKETS + 1)[:-1]
        hot = np.flatnonzero(counts >= least)
        limit = max(rules, len(hot) // 8)
        if len(hot) > limit:
            hot = np.sort(hot[np.argpartition(counts[hot], -limit)[-limit:]])
        slot = np.full(_BUCKETS + 1, -1, np.int32)
        slot[hot] = np.arange(len(hot))
        which = slot[buckets]
        at = np.flatnonzero(which >= 0)
        which, pairs = which[at], s[at].astype(np.uint64) << np.uint64(32) | s[at + 1]
        # pairs that share a bucket: the part of it that most occurrences fall in names the pair
        part = which * 256 + (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int32)
        most = np.bincount(part, minlength=256 * len(hot)).reshape(-1, 256).argmax(axis=1) if len(hot) else np.zeros(0, int)
        named = np.zeros(len(hot), np.uint64)
        main = part == (np.arange(len(hot)) * 256 + most)[which] if len(hot) else np.zeros(0, bool)
        named[which[main]] = pairs[main]
        same = named[which] == pairs
        n = np.bincount(which[same], minlength=len(hot))
        chosen = np.flatnonzero(n >= least)
        if not len(chosen):
            break
        number = np.full(len(hot), -1)
        number[chosen] = np.arange(len(chosen))
        at, which, pairs = at[same], which[same], named
        rule = number[which]
        at, rule = at[rule >= 0], rule[rule >= 0]
        index = np.arange(len(at))  # of neighbouring occurrences, every other one from the left is replaced
        fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
        take = (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
        at, rule = at[take], rule[take]
        s[at] = base + len(grammar) + rule
        last[at] = last[at + 1]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s, last = s[keep], last[keep]
        grammar = np.concatenate((grammar, np.stack((pairs[chosen] >> np.uint64(32), pairs[chosen] & np.uint64(0xFFFFFFFF)), axis=1).astype(np.uint32)))
    sizes = expansion_lengths(grammar, base)
    ends = np.zeros(len(lengths), np.int64)
    ends[lengths > 0] = np.flatnonzero(last) + 1
    ends = np.maximum.accumulate(ends) if len(ends) else ends
    wide = base + len(grammar) > 1 << 16
    head = np.array([MAGIC, base, len(grammar), len(lengths), len(s), wide], np.int64)
    return b"".join(x.tobytes() for x in (head, grammar, sizes.astype(np.uint32), ends, s.astype(np.uint32 if wide else np.uint16)))


def expansion_lengths(grammar: np.ndarray, base: int) -> np.ndarray:
    sizes: list[int] = []
    for a, b in grammar.tolist():
        sizes.append((sizes[a - base] if a >= base else 1) + (sizes[b - base] if b >= base else 1))
    return np.array(sizes, np.int64)


class Shard:
    """The file of a shard, open for random access."""

    def __init__(self, data: bytes):
        magic, self.base, rules, docs, symbols, wide = np.frombuffer(data, np.int64, 6).tolist()
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = 48
        self.grammar = np.frombuffer(data, np.uint32, 2 * rules, at).reshape(-1, 2)
        self.sizes = np.frombuffer(data, np.uint32, rules, at := at + 8 * rules)
        self.ends = np.frombuffer(data, np.int64, docs, at := at + 4 * rules)
        self.symbols = np.frombuffer(data, np.uint32 if wide else np.uint16, symbols, at + 8 * docs)

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        return np.where(symbols >= self.base, self.sizes[np.maximum(symbols.astype(np.int64) - self.base, 0)] if len(self.sizes) else 1, 1).astype(np.int64)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids these symbols stand for: only rules that occur below them are looked at."""
        symbols = symbols.astype(np.uint32)
        while (rule := symbols >= self.base).any():
            wide = np.repeat(symbols, 1 + rule)
            at = np.flatnonzero(rule)
            at += np.arange(len(at))
            pairs = self.grammar[symbols[rule] - self.base]
            wide[at], wide[at + 1] = pairs[:, 0], pairs[:, 1]
            symbols = wide
        return symbols

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the end of each document among them. Each rule is expanded once."""
        texts: list[np.ndarray] = []
        one = lambda x: texts[x - self.base] if x >= self.base else np.array([x], np.uint32)
        for a, b in self.grammar.tolist():
            texts.append(np.concatenate((one(a), one(b))))
        table = np.concatenate((np.arange(self.base, dtype=np.uint32), *texts))
        length = np.concatenate((np.ones(self.base, np.int64), self.sizes.astype(np.int64)))
        sizes = length[self.symbols]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        starts = np.concatenate(([0], np.cumsum(length)[:-1]))
        return table[np.repeat(starts[self.symbols] - ends[:-1], sizes) + np.arange(ends[-1])], ends[self.ends]

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """ids start to stop of document k: by the lengths of its symbols, only those that cover them are expanded."""
        own = self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]]
        ends = np.cumsum(self.lengths(own))
        stop = int(ends[-1]) if stop is None and len(ends) else stop or 0
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped : stop - skipped]


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard: int = SHARD, end: int = END) -> None:
    """Writes the shards of docs (doc_id, text) to path: part, shard, doc_ids, n_tokens, payload."""
    tokenizer = tokenizer or public_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("encoder", tokenizer), lambda: Encoder(tokenizer))
        tail = np.array([end], encoder.dtype)
        ids, names, held, number, part = [], [], 0, 0, 0

        def out() -> pa.RecordBatch:
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            payload = compress(np.concatenate(ids), lengths, encoder.vocabulary)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([names], pa.list_(pa.int64())), pa.array([int(lengths.sum())]), pa.array([payload], pa.binary())], ["part", "shard", "doc_ids", "n_tokens", "payload"])

        for batch in sized(batches, 2, BATCH, 16 * BATCH):
            part = batch.column(0)[0].as_py()
            for name, own in zip(batch.column(1).to_pylist(), encoder.encode_column(batch.column(2))):
                ids.append(np.concatenate((own, tail)))
                names.append(name)
                held += len(own) + 1
                if held >= shard:
                    yield out()
                    ids, names, held, number = [], [], 0, number + 1
        if ids:
            yield out()

    order = [F.col("doc_id").asc_nulls_first(), "__hash", "__row"]
    marked = docs.select("doc_id", "text").withColumns({"__hash": F.xxhash64(body("text")), "__row": F.monotonically_increasing_id()})
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(run), SCHEMA).write.parquet(path)


SCHEMA = "part int, shard int, doc_ids array<bigint>, n_tokens bigint, payload binary"


def decoded(spark, path: str) -> DataFrame:
    """part, shard, doc_id, within, n_tokens, ids (little-endian unsigned 32-bit) of each document in the shards at path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, ends = Shard(batch.column(3)[0].as_py()).all()
            starts = np.concatenate(([0], ends[:-1]))
            n = len(ends)
            data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.concatenate((starts[:1], ends)).astype(np.int32) * np.int32(4)), pa.py_buffer(ids.astype("<u4"))])
            same = lambda k: pa.array(np.full(n, batch.column(k)[0].as_py(), np.int32))
            yield pa.RecordBatch.from_arrays([same(0), same(1), batch.column(2).flatten(), pa.array(starts), pa.array(ends - starts), data], ["part", "shard", "doc_id", "within", "n_tokens", "ids"])

    files = spark.read.schema(SCHEMA).parquet(path)
    return files.select("part", "shard", "doc_ids", "payload").mapInArrow(tidied(run), "part int, shard int, doc_id bigint, within bigint, n_tokens bigint, ids binary")


def first_ids(spark, path: str) -> DataFrame:
    """part, shard, first: the number of ids before each shard. Sums of parts come first, so no task sees all shards."""
    files = spark.read.schema(SCHEMA).parquet(path).select("part", "shard", "n_tokens")
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return files.withColumn("inner", inner).join(totals, "part").select("part", "shard", (F.col("before") + F.col("inner")).alias("first"))


def read(spark, path: str, payload: str = "ids") -> DataFrame:
    """doc_id, start, n_tokens and an expression over ids, by default ids itself, which alone is moved to the start."""
    texts = decoded(spark, path).selectExpr("part", "shard", "doc_id", "within", "n_tokens", payload)
    joined = texts.join(first_ids(spark, path), ["part", "shard"])
    return joined.withColumn("start", F.col("first") + F.col("within")).drop("part", "shard", "first", "within")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the files that docs were written to."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path, "crc32(ids) AS ids_crc32").select("doc_id", "start", "n_tokens", "ids_crc32")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
