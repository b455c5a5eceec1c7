"""URL filter: a sorted digest array, memory-mapped, probed by binary search and confirmed on the stored strings.

A rule is a host and a path prefix with an action; its key is `host/path`. A term is a word that hosts are blocked for; its
key is `?term`, which no host or path can begin with. Spark hashes the keys to 64 bits (xxHash) and sorts them by range; sorted
hashes, the ends of the keys and the keys themselves form one file, which Spark ships to every executor once and which Python
workers map into memory together. For a url, every host suffix is combined with every prefix of its path that has the length
of a rule's path (the lengths stand in the file's head), and every word of the host is tried as a term; all probes of a batch
are searched in one vectorised binary search, and a hash that is found counts only if the stored key is equal, so collisions
change nothing. The longest rule that fits decides; where none does, a host with a blocked term is blocked and all else allowed.

Rules that take more than SHIPPED bytes together, measured, are not shipped: the probes of the pages are joined with the rules
by digest and compared in full. Probes that make up more than a thousandth of all, a thousand at most, are looked up apart and
joined by broadcast, so that no key gathers a large share of the pages in one task.

Rules are given as a list or a DataFrame (host, path, action). A url without `://`, or null, has an empty host and path, fits
no rule and is allowed. Empty rule and term lists, empty tables, repeated rows and urls of any length are fine; of equal rules
the last one holds, in the order of the list or of the rows as Spark numbers them. A rule with a null is none. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ascii_lower, per_worker, raw, scratch, slices, small, stored, tidied

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Words of hosts that sell gambling, drugs, pornography or pirated software.
TERMS = ["bets", "betting", "casino", "escort", "pills", "poker", "porn", "viagra", "warez", "xxx"]
#: Bytes of rules that are shipped; share of all probes from which on one is hot; what keys of terms begin with.
SHIPPED, HOT, TERM = 64 << 20, 1000, b"?"


def digest(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, 42)


def pack(keys: pa.Table, lengths: list[int]) -> bytes:
    """The file: count, number of path lengths, those lengths, sorted hashes, key ends, actions (1: block), key bytes. keys:
    digest (signed, ascending), key, block; keys of equal hash stand side by side."""
    names = keys["key"].cast(pa.large_binary())
    ends = np.cumsum(pc.binary_length(names).to_numpy(), dtype=np.int64)
    head = np.array([keys.num_rows, len(lengths), *lengths], np.int64).tobytes()
    return b"".join((head, keys["digest"].to_numpy().astype(np.int64).tobytes(), ends.tobytes(), keys["block"].to_numpy().astype(np.uint8).tobytes(), *names.to_pylist()))


class Digests:
    """The file, mapped; nothing of it is read before it is probed."""

    def __init__(self, path: str, hashed: Callable = digest):
        file = np.memmap(path, np.uint8, mode="r")
        n, paths = file[:16].view(np.int64).tolist()
        at = 16 + 8 * paths
        self.path_lengths = file[16:at].view(np.int64).tolist()
        self.hashes, self.ends = file[at : at + 8 * n].view(np.int64), file[at + 8 * n : at + 16 * n].view(np.int64)
        self.block, self.keys, self.n, self.hashed = file[at + 16 * n : at + 17 * n], file[at + 17 * n :], n, hashed

    def key(self, k: int) -> bytes:
        return self.keys[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])].tobytes()

    def find(self, probes: list[bytes]) -> list[int]:
        """The index of each probe, -1 where it is not stored."""
        wanted = np.fromiter(map(self.hashed, probes), np.uint64, len(probes)).view(np.int64)
        at = np.searchsorted(self.hashes, wanted)
        found = np.full(len(probes), -1)
        for p in np.flatnonzero((at < self.n) & (self.hashes[np.minimum(at, self.n - 1)] == wanted)) if self.n else ():
            k = int(at[p])
            while k < self.n and self.hashes[k] == wanted[p]:
                if self.key(k) == probes[p]:
                    found[p] = k
                    break
                k += 1
        return found.tolist()


def parts(url: bytes) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path."""
    _, mark, rest = url.partition(b"://")
    if not mark:
        return b"", b""
    cut = min((i for i in map(rest.find, (b"/", b"?", b"#")) if i >= 0), default=len(rest))
    tail = rest[cut:]
    end = min((i for i in map(tail.find, (b"?", b"#")) if i >= 0), default=len(tail))
    return rest[:cut].lower(), tail[:end]


def probes(host: bytes, path: bytes, lengths: list[int]) -> list[bytes]:
    """Keys that would fit, the longest first; of equal length the bytewise largest."""
    labels = host.split(b".")
    suffixes = [b".".join(labels[k:]) for k in range(len(labels))] if host else []
    return sorted({s + path[:n] for s in suffixes for n in lengths if n <= len(path)}, key=lambda k: (len(k), k), reverse=True)


def host_words(host: bytes) -> list[bytes]:
    return [TERM + w for w in dict.fromkeys(host.replace(b"-", b".").split(b".")) if w]


def keys_of(spark: SparkSession, rules: Iterable[tuple[str, str, str]] | DataFrame, terms: Iterable[str]) -> DataFrame:
    """digest, key, block, path (bytes of the rule's path, null for a term) of each different key."""
    if isinstance(rules, DataFrame):
        given = rules.select(F.monotonically_increasing_id().alias("place"), "host", "path", "action")
    else:
        given = spark.createDataFrame([(k, *rule) for k, rule in enumerate(rules)], "place bigint, host string, path string, action string")
    block = F.col("action") == "block"
    rows = given.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL").select("place", F.concat(ascii_lower(F.col("host")), "path").alias("key"), block.alias("block"), F.octet_length("path").alias("path"))
    words = spark.createDataFrame([(TERM.decode() + t.lower(),) for t in terms], "key string").select(F.lit(0).cast("bigint").alias("place"), "key", F.lit(True).alias("block"), F.lit(None).cast("int").alias("path"))
    last = F.struct("place", "block", "path")
    one = rows.where(~F.col("key").startswith(TERM.decode())).unionByName(words).groupBy("key").agg(F.max(last).alias("last"))
    out = one.select(F.xxhash64("key").alias("digest"), F.col("key").cast("binary").alias("key"), "last.block", "last.path")
    return stored(out, "rules") if isinstance(rules, DataFrame) else out


def ship(spark: SparkSession, keys: DataFrame, lengths: list[int]) -> str:
    """Writes the file to the shared folder and has Spark fetch it to every executor; its name there. keys: of measured size."""
    data = pack(keys.select("digest", "key", "block").orderBy("digest", "key").toArrow(), lengths)
    name = f"urls-{hashlib.sha256(data).hexdigest()[:16]}.bin"
    context = spark.sparkContext
    if not any(f.rsplit("/", 1)[-1] == name for f in context.listFiles):
        path = f"{scratch(spark, 'urls')}/{name}"
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(context._jsc.hadoopConfiguration()).create(at, True)
        for k in range(0, len(data), 4 << 20):
            stream.write(bytearray(data[k : k + (4 << 20)]))
        stream.close()
        context.addFile(path)
    return name


def mapped(pages: DataFrame, name: str) -> DataFrame:
    """page_id, host, path, rule, verdict by the shipped file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored_ = per_worker(("urls", name), lambda: Digests(SparkFiles.get(name)))
        for batch in slices(batches, 4096):
            split = [parts(u) for u in raw(batch.column(1))]
            tries = [(probes(h, p, stored_.path_lengths), host_words(h)) for h, p in split]
            hits = iter(stored_.find([t for keys, words in tries for t in (*keys, *words)]))
            rules, verdicts = [], []
            for keys, words in tries:
                best = next((k for k in [next(hits) for _ in keys] if k >= 0), -1)
                named = max([next(hits) for _ in words], default=-1)
                rules.append(stored_.key(best) if best >= 0 else None)
                verdicts.append("block" if (stored_.block[best] if best >= 0 else named >= 0) else "allow")
            text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text([h for h, _ in split]), text([p for _, p in split]), text(rules), pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(tidied(run), f"page_id {kind}, host string, path string, rule string, verdict string")


def joined(pages: DataFrame, keys: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by a join of all probes with the rules, for rules too many to be shipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            split = [parts(u) for u in raw(batch.column(2))]
            tries = [[*probes(h, p, lengths), *host_words(h)] for h, p in split]
            text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text([h for h, _ in split]), text([p for _, p in split]), pa.array(tries, pa.list_(pa.binary()))], ["row", "page_id", "host", "path", "tries"])

    kind = pages.schema["page_id"].dataType.simpleString()
    numbered = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url")
    split = stored(numbered.mapInArrow(tidied(run), f"row bigint, page_id {kind}, host string, path string, tries array<binary>"), "probes")
    tries = split.select("row", F.explode("tries").alias("key"))
    asked = stored(tries.groupBy("key").count(), "asked")
    total = asked.agg(F.sum("count")).first()[0] or 0
    rules = keys.select(F.col("digest").alias("__digest"), F.col("key").alias("rule"), "block")
    met = lambda left: left.join(rules, (F.xxhash64("key") == F.col("__digest")) & (F.col("key") == F.col("rule"))).drop("__digest", "rule")
    often = asked.where(F.col("count") * HOT > total).select("key")  # fewer than HOT
    rare = tries.join(small(often), "key", "left_anti")
    hits = met(rare).unionByName(tries.join(small(met(often)), "key"))
    best = hits.groupBy("row").agg(F.max(F.struct((~F.col("key").startswith(F.lit(TERM))).alias("own"), F.octet_length("key").alias("size"), F.col("key").cast("string").alias("rule"), "block")).alias("best"))
    rule = F.when(F.col("best.own"), F.col("best.rule")).alias("rule")
    verdict = F.when(F.coalesce("best.block", F.lit(False)), "block").otherwise("allow").alias("verdict")
    return split.select("row", "page_id", "host", "path").join(best, "row", "left").select("page_id", "host", "path", rule, verdict)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] | DataFrame = tuple(RULES), terms: Iterable[str] = tuple(TERMS), shipped: int = SHIPPED) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages."""
    spark = pages.sparkSession
    keys = keys_of(spark, rules, terms)
    lengths = sorted(r["path"] for r in keys.select("path").distinct().collect() if r["path"] is not None)  # of different lengths alone
    size = keys.agg(F.sum(F.octet_length("key") + 17)).first()[0] or 0
    return mapped(pages, ship(spark, keys, lengths)) if size <= shipped else joined(pages, keys, lengths)


ORACLE = f"""
WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT page_id, h || p AS rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
  FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT s.page_id, host, path, rule, coalesce(action, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'), {TERMS}) THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN m ON m.page_id = s.page_id AND k = 1
"""
