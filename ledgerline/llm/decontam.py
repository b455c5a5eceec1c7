"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are partitioned by their number of distinct five-word shingles (powers of two). Within a partition every item keeps
a sketch, the k shingles that come first in an order common to all items: by the number of items that hold a shingle, then by
its hash. k follows from the partition's upper size u: an item of q shingles that a document contains to the share t misses
at most m = floor((1 - t) q) of them, so with k = floor((1 - t) u) + 1 the document holds at least k - m hashes of the sketch,
and one of the first m + 1 in any case. The search is thus free of misses, which sketches of long documents with their tiny
Jaccard similarity to a short item would not be.

Documents are probed where they lie: their shingle hashes meet the different hashes of all sketches in a broadcast join, whose
size is measured, and only what is met leaves the task. Of that, the first m + 1 hashes of an item open a pair, and a pair
goes on if it holds enough of the sketch. What many items share stands last in the order, so it opens pairs only for items
made of it to the share t or more, which the documents that hold it do contain. Each pair is then verified by the exact share
of the item's shingles, compared as text.

Words are maximal runs of letters and digits, lower-cased; an item in a script without spaces is one word. An item of fewer
than five words has one shingle, its whole word sequence, and is found wherever a document holds it; one without words, and
null ones, are never matched. Items with equal sets of shingles are searched once. Rows that share a doc_id or an item_id
count as one, in contaminated() those without a doc_id too; clean() judges these one by one. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import body, keyed, passing, small, stored

SHINGLE, CONTAINMENT = 5, 0.8
SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(body(text)), SEPARATOR), "")


def _windows(parts: Column, of, size: int) -> Column:
    """of(k) for each start k of a window of that many words, null for fewer. parts is a column, not an expression, as it is
    looked up for each window."""
    return F.when(F.size(parts) >= size, F.transform(F.sequence(F.lit(0), F.size(parts) - size), of))


def _text(parts: Column, size: int) -> Column:
    return F.coalesce(_windows(parts, lambda k: F.concat_ws(" ", F.slice(parts, k + 1, size)), size), F.array().cast("array<string>"))


def shingles(parts: Column) -> Column:
    """An item's shingles: of five words, or the whole sequence if it is shorter."""
    return F.when(F.size(parts) >= SHINGLE, _text(parts, SHINGLE)).when(F.size(parts) > 0, F.array(F.array_join(parts, " "))).otherwise(F.array().cast("array<string>"))


def hashes(parts: Column, size: int = SHINGLE) -> Column:
    """Hash of each window: word hashes are made once and combined, no shingle text is built."""
    return F.coalesce(_windows(parts, lambda k: F.xxhash64(*[F.get(parts, k + i) for i in range(size)]), size), F.array().cast("array<bigint>"))


def _all(parts: Column, of, sizes: Sequence[int]) -> Column:
    """Windows of five words and those of the lengths that short items have."""
    every = [of(parts, n) for n in (SHINGLE, *sizes)]
    return F.concat(*every) if len(every) > 1 else every[0]


def item_sets(items: DataFrame) -> tuple[DataFrame, DataFrame, list[int], DataFrame]:
    """item_id, set of each item with a shingle; set, shingles, q for each different set of them; lengths of short items; the
    written table that both come from."""
    cut = items.select("item_id", words(F.col("text")).alias("w"))
    own = cut.select("item_id", F.least(F.size("w"), F.lit(SHINGLE)).alias("size"), F.explode(shingles(F.col("w"))).alias("shingle"))
    each = own.groupBy("item_id").agg(F.array_sort(F.collect_set("shingle")).alias("shingles"), F.collect_set("size").alias("sizes"))
    named = stored(each.withColumn("set", F.sha2(F.array_join("shingles", "\n"), 256)), "items")
    sizes = sorted(r[0] for r in named.select(F.explode("sizes").alias("n")).distinct().collect() if r[0] < SHINGLE)  # at most four
    return named.select("item_id", "set"), named.groupBy("set").agg(F.first("shingles").alias("shingles")).withColumn("q", F.size("shingles")), sizes, named


def sketches(sets: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """set, hash, opens, need: the sketch of each set, which of its hashes open a pair, and how many a document must hold."""
    one = F.transform(F.split("s", " "), lambda x: F.xxhash64(x))  # a null, as in short ones, leaves a hash as it is
    each = sets.select("set", "q", F.explode("shingles").alias("s")).select("set", "q", one.alias("w")).select("set", "q", F.xxhash64(*[F.get("w", F.lit(i)) for i in range(SHINGLE)]).alias("hash")).distinct()
    common = each.groupBy("hash").agg(F.count("*").alias("held"))
    misses = lambda size: F.floor(F.round(size * (1 - containment), 9)).cast("int")
    k = F.least(F.col("q"), misses(F.pow(F.lit(2.0), F.ceil(F.log2(F.col("q").cast("double"))))) + 1)
    ranked = each.join(common, "hash").withColumn("place", F.row_number().over(Window.partitionBy("set").orderBy("held", "hash")))
    return ranked.where(F.col("place") <= k).select("set", "hash", (F.col("place") <= misses(F.col("q")) + 1).alias("opens"), F.greatest(F.lit(1), k - misses(F.col("q"))).alias("need"))


def candidates(docs: DataFrame, sketch: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """doc_id, set of the pairs that hold enough of the sketch."""
    parts = docs.select("doc_id", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("w"))
    probes = parts.select("doc_id", F.explode(_all(F.col("w"), hashes, sizes)).alias("hash"))
    met = stored(probes.join(small(sketch.select("hash").distinct()), "hash").select("doc_id", "hash").distinct(), "met")
    pairs = met.join(small(sketch.where("opens").select("hash", "set")), "hash").select("doc_id", "set").distinct()
    wanted = pairs.join(small(sketch.select("set", "hash", "need")), "set").select(F.col("doc_id").alias("d"), "set", F.col("hash").alias("h"), "need")
    held = wanted.join(met, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("hash")))
    return held.groupBy("doc_id", "set", "need").agg(F.count("*").alias("n")).where("n >= need").select("doc_id", "set")


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment for each pair where the document holds at least that share of the item."""
    with passing(docs.sparkSession) as keep:
        members, sets, sizes, table = item_sets(items)
        pairs = stored(candidates(docs, stored(sketches(sets, containment), "sketches"), sizes), "pairs")
        keep(table, pairs)
    named = pairs.join(small(sets.join(pairs.select("set").distinct(), "set", "left_semi")), "set")
    suspects = keyed(docs.select("doc_id", "text"), pairs, "left_semi").select(F.col("doc_id").alias("__doc"), words(F.col("text")).alias("w"))
    held = suspects.select("__doc", F.array_distinct(_all(F.col("w"), _text, sizes)).alias("held"))
    both = held.join(small(named), F.col("__doc").eqNullSafe(F.col("doc_id")))
    shared = both.select("doc_id", "set", "q", F.explode(F.array_intersect("shingles", "held")).alias("s")).groupBy("doc_id", "set", "q").agg(F.countDistinct("s").alias("n_shared"))
    found = shared.withColumn("containment", F.col("n_shared").cast("double") / F.col("q").cast("double")).where(F.col("containment") >= containment)
    return found.join(small(members), "set").select("doc_id", "item_id", "n_shared", F.col("q").cast("bigint").alias("n_item"), "containment")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that contain a benchmark item, all columns as they were. Rows without a doc_id are judged one by one."""
    with passing(docs.sparkSession) as keep:
        found = stored(contaminated(docs.where("doc_id IS NOT NULL"), items).select("doc_id"), "leaks")
        nameless = stored(docs.where("doc_id IS NULL").withColumn("__row", F.monotonically_increasing_id()), "nameless")
        some = not nameless.isEmpty()
        if some:
            rows = contaminated(nameless.select(F.col("__row").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("__leak")).distinct()
            rows = stored(rows, "nameless_leaks")
            keep(nameless, rows)
        keep(found)
    named = keyed(docs, found, "left_anti")
    if not some:
        return named
    return named.where("doc_id IS NOT NULL").unionByName(nameless.join(rows, F.col("__row") == F.col("__leak"), "left_anti").drop("__row"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
z AS (SELECT DISTINCT least(len(w), 5) AS z FROM b WHERE len(w) > 0 UNION SELECT 5),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - z + 2), lambda i: array_to_string(w[i:i + z - 1], ' '))) AS s FROM d, z WHERE len(w) >= z),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*)::DOUBLE / n_item::DOUBLE AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*)::DOUBLE / n_item::DOUBLE >= 0.8
"""
