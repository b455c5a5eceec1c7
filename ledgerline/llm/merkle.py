"""Merkle manifest of a dataset, with a proof of each row by looked-up coordinates.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests enter as their hex text. A row's leaf is H of its columns,
each as its UTF-8 byte count, a colon and its value, or `-` if null. The leaves of a group (a source) ascend by their key;
while a level has several nodes, each ARITY consecutive ones, a run, become one node of the next level. The one that is left
is the group's subroot. The subroots, null group first, then bytewise, make a tree of their own, whose last node is the root.

The position of a leaf comes from a range sort: a row's place within its partition, less where its group begins there, plus
the rows that the group has in partitions before. So a group that holds a third of all rows is dealt out like any other, and
only one row a partition and group is summed up. The node table has a row for each run of a level: its digests in order.

A coordinate is (tree, level, run, slot). From its position and its group's size a leaf knows all coordinates whose siblings it
needs: on each level the run that holds its ancestor, and the slots there but the ancestor's own. The ARITY leaves of one run
need the same from level 1 on, so these coordinates are exploded once a run, joined with the node table, put in order, and
concatenated (the proof) or folded (the root as it follows from a leaf) for each leaf. Runs near the top are needed by very
many: one that more than SHARED runs ask for is laid out in as many copies as keep each copy under that, and askers are dealt
out over the copies. No table is broadcast for its size alone.

Nulls: a null group is a group, a null key comes first in it. Rows with equal keys are ordered by their leaves, so the root does
not depend on which comes first; repeated rows are leaves each. No rows give no root. Columns beside those that enter leaves
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import LOWER, UPPER, ascii_lower, passing, stored

ARITY, WIDTH, SHARED = 16, 64, 1 << 16
#: Tree of the subroots; groups are named by `=` and their value, the null group by nothing.
TOP = "#"
PATH = "array<struct<step:int,digests:string,slot:int>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def entered(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return digest(F.concat(*map(entered, columns)))


@dataclass
class Manifest:
    """runs: tree, run, size (leaves of the tree), leaves (at, key, leaf, other). nodes: tree, level, run, digests, one row for each
    run of more than one node's tree. groups: tree, size, place, count (of groups), subroot. depth: levels of the highest tree; root: the digest,
    None of no rows; count: groups."""

    runs: DataFrame
    nodes: DataFrame
    groups: DataFrame
    depth: int
    count: int
    root: str | None


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows with `at` (from 0, in the group by order) and `size` (of the group). rows: a written table."""
    sort = [group, *order]
    placed = stored(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("__part", F.shiftright("__place", 33))
    spans = placed.groupBy(group, "__part").agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(group)
    before = F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(group, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("size"))
    return placed.join(spans, [group, "__part"]).withColumn("at", F.col("__place") + F.col("__shift")).drop("__place", "__part", "__shift")


def levels(size: int) -> int:
    n = 0
    while ARITY**n < size:
        n += 1
    return n


def _above(at: Column, level: int) -> Column:
    """The place, `level` levels up, of what holds a place."""
    return F.shiftright(at, 4 * level)


def _runs(nodes: DataFrame) -> DataFrame:
    """tree, run, size, digests of the nodes of a level (tree, at, size, node)."""
    own = F.sort_array(F.collect_list(F.struct("at", "node")))
    return nodes.groupBy("tree", _above(F.col("at"), 1).alias("run")).agg(F.first("size").alias("size"), F.array_join(F.transform(own, lambda x: x["node"]), "").alias("digests"))


def grown(runs: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """From the runs of level 0 (tree, run, size, digests): the node table, and the last node of each tree (tree, size, node)."""
    tables, tops = [], [runs.where("size = 1").select("tree", "size", F.col("digests").alias("node"))]
    runs = runs.where("size > 1")
    for level in range(max(1, depth)):
        tables.append(runs.select("tree", F.lit(level).alias("level"), "run", "digests"))
        up = runs.select("tree", F.col("run").alias("at"), "size", digest(F.col("digests")).alias("node"))
        last = F.col("size") <= ARITY ** (level + 1)
        tops.append(up.where(last).select("tree", "size", "node"))
        if level < depth - 1:
            runs = stored(_runs(up.where(~last)), f"level{level + 1}")
    return reduce(DataFrame.union, tables), reduce(DataFrame.union, tops)


def manifest(docs: DataFrame, columns: list[str], key: str, group: str, other: Column | None = None) -> Manifest:
    """The tree over docs: a leaf for each row of these columns, by group and key. other: a digest kept beside a row's leaf."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaf = leaf_digest(*[F.col(f"`{c}`") for c in columns])
    entries = stored(docs.select(F.col(key).alias("key"), tree.alias("tree"), leaf.alias("leaf"), (F.lit(None).cast("string") if other is None else other).alias("other")), "leaves")
    placed = ranked(entries, "tree", ["key", "leaf"], "placed")
    own = F.sort_array(F.collect_list(F.struct("at", "leaf", "key", "other")))
    runs = stored(placed.groupBy("tree", _above(F.col("at"), 1).alias("run")).agg(F.first("size").alias("size"), own.alias("leaves")), "runs")
    most = runs.agg(F.max("size")).first()[0] or 0
    base = runs.select("tree", "run", "size", F.array_join(F.transform("leaves", lambda x: x["leaf"]), "").alias("digests"))
    nodes, tops = grown(base, levels(most))

    subroots = stored(tops.select("tree", F.col("size").alias("rows"), F.col("node").alias("subroot"), F.lit(TOP).alias("top")), "subroots")
    groups = stored(ranked(subroots, "top", ["tree"], "groups").select("tree", F.col("rows").alias("size"), F.col("at").alias("place"), F.col("size").alias("count"), "subroot"), "places")
    count = (groups.agg(F.max("count")).first()[0]) or 0
    upper, last = grown(stored(_runs(groups.select(F.lit(TOP).alias("tree"), F.col("place").alias("at"), F.col("count").alias("size"), F.col("subroot").alias("node"))), "top0"), levels(count))
    nodes = stored(nodes.union(upper), "nodes")
    found = last.first()
    return Manifest(runs, nodes, groups, levels(most), count, found and found["node"])


def coordinates(size: Column, at: Column, least: int, depth: int) -> Column:
    """Of a leaf at a place of a tree: level, run and slot of its ancestors, from level `least` on. Its siblings there are the other
    slots of the run: ARITY of them together, in the last run what is left of the level."""
    steps = [
        F.when(size > ARITY**n, F.struct(F.lit(n).alias("level"), _above(at, n + 1).alias("run"), F.pmod(_above(at, n), F.lit(ARITY)).cast("int").alias("slot")))
        for n in range(least, depth)
    ]
    return F.array_compact(F.array(*steps)) if steps else F.from_json(F.lit("[]"), "array<struct<level:int,run:bigint,slot:int>>")


def looked_up(askers: DataFrame, ids: list[str], tree: Column, wanted: Column, nodes: DataFrame, leaf_runs: int) -> DataFrame:
    """ids, path: the digests of the runs at the wanted coordinates, by level. leaf_runs: how many askers stand below a run of level 1
    of the table, for the copies of what lies higher."""
    copies = F.greatest(F.lit(1), F.pow(F.lit(float(ARITY)), F.col("level") - 1) * leaf_runs / SHARED).cast("int")
    asked = askers.select(*ids, tree.alias("__tree"), F.explode(wanted).alias("__at"))
    asked = asked.select(*ids, "__tree", F.col("__at.level").alias("level"), F.col("__at.run").alias("__run"), F.col("__at.slot").alias("slot"))
    asked = asked.withColumn("__copy", F.pmod(F.xxhash64(*ids), copies).cast("int"))
    table = nodes.select(F.col("tree").alias("__tree"), "level", F.col("run").alias("__run"), "digests", F.explode(F.sequence(F.lit(0), copies - 1)).alias("__copy"))
    found = asked.join(table, ["__tree", "level", "__run", "__copy"])
    return found.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct(F.col("level").alias("step"), "digests", "slot"))).alias("path"))


def _beside(step: Column) -> tuple[Column, Column]:
    """What stands before and behind the slot of a path's step."""
    width = step["slot"] * WIDTH
    return step["digests"].substr(F.lit(1), width), step["digests"].substr(width + WIDTH + 1, F.lit(ARITY * WIDTH))


def proofs(made: Manifest) -> DataFrame:
    """key, leaf, other, subroot, path of each row: the runs on its way to the root, level by level, with its own slot in each."""
    no_path = F.lit(None).cast(PATH)
    depth = levels(made.count)
    above = looked_up(made.groups, ["tree"], F.lit(TOP), coordinates(F.lit(made.count), F.col("place"), 0, depth), made.nodes.where(F.col("tree") == TOP), ARITY**2) if depth else made.groups.select("tree", no_path.alias("path"))
    copies = F.floor(F.col("size") / (ARITY * SHARED)).cast("int") + 1
    groups = made.groups.join(above.withColumnRenamed("path", "above"), "tree", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).select("tree", "copy", "subroot", "above")
    wanted = coordinates(F.col("size"), F.shiftleft("run", 4), 1, made.depth)
    within = looked_up(made.runs, ["tree", "run"], F.col("tree"), wanted, made.nodes, ARITY) if made.depth > 1 else made.runs.select("tree", "run", no_path.alias("path")).where(F.lit(False))
    runs = made.runs.join(within, ["tree", "run"], "left").withColumn("copy", F.pmod("run", copies).cast("int")).join(groups, ["tree", "copy"])

    digests = F.array_join(F.transform("leaves", lambda x: x["leaf"]), "")
    rows = runs.select("size", digests.alias("digests"), F.coalesce("path", F.array().cast(PATH)).alias("within"), F.coalesce("above", F.array().cast(PATH)).alias("above"), "subroot", F.explode("leaves").alias("own"))
    first = F.struct(F.lit(0).alias("step"), F.col("digests"), F.pmod(F.col("own.at"), F.lit(ARITY)).cast("int").alias("slot"))
    path = F.concat(F.when(F.col("size") > 1, F.array(first)).otherwise(F.array().cast(PATH)), "within", "above")
    return rows.select("own.key", "own.leaf", "own.other", "subroot", path.alias("path"))


def siblings(path: Column) -> Column:
    """The digests of a proof, level by level, from left to right, in one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(*_beside(step))), "")


def folded(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and its siblings."""

    def up(node: Column, step: Column) -> Column:
        before, behind = _beside(step)
        return digest(F.concat(before, node, behind))

    return F.aggregate(path, leaf, up)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def audit(docs: DataFrame) -> DataFrame:
    """Documents' leaves, subroots, proofs and what verifying them gives, where every fifth by crc32 of doc_id is verified with a text
    whose A-Z have been lower-cased. A null doc_id is never tampered with."""
    with passing(docs.sparkSession) as keep:
        changed = leaf_digest(*[ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS])
        made = manifest(docs.select(*COLUMNS), COLUMNS, "doc_id", "source", F.when(tampered(F.col("doc_id")), changed))
        keep(made.runs, made.nodes, made.groups)
        rows = proofs(made)
    columns = [F.col("key").alias("doc_id"), "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), digest(siblings(F.col("path"))).alias("proof_sha256"), folded(F.col("path"), F.coalesce("other", "leaf")).alias("folded_root")]
    return rows.select(*columns).withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 of a column's decimal text. Digits pass through the reflected polynomial's table, which is made by its rule.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"
CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295)"


def _sql_leaf(text: str) -> str:
    columns = [text if c == "text" else c for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in columns) + ")"


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_sql_leaf('text')} AS leaf,
           CASE WHEN {CRC.format('doc_id')} % 5 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
    FROM documents, crc),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size FROM leaves),
own(tree, level, pos, size, node) AS (
    SELECT tree, 0, pos, size, leaf FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 16, size, sha256(string_agg(node, '' ORDER BY pos)) FROM own WHERE size > pow(16, level)::BIGINT GROUP BY tree, level, pos // 16, size),
subroots AS (
    SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
    FROM (SELECT * FROM own QUALIFY level = max(level) OVER (PARTITION BY tree))),
upper(level, pos, size, node) AS (
    SELECT 0, place, n, subroot FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, size, sha256(string_agg(node, '' ORDER BY pos)) FROM upper WHERE size > pow(16, level)::BIGINT GROUP BY level, pos // 16, size),
rows AS (SELECT row_number() OVER () AS r, p.*, s.subroot, s.place, s.n FROM placed p JOIN subroots s USING (tree)),
steps AS (
    SELECT r, level AS step, o.pos AS slot, node, o.pos = d.pos // pow(16, level)::BIGINT AS mine FROM rows d JOIN own o ON o.tree = d.tree AND o.pos // 16 = d.pos // pow(16, level + 1)::BIGINT AND d.size > pow(16, level)::BIGINT
    UNION ALL
    SELECT r, 100 + level, u.pos, node, u.pos = d.place // pow(16, level)::BIGINT FROM rows d JOIN upper u ON u.pos // 16 = d.place // pow(16, level + 1)::BIGINT AND d.n > pow(16, level)::BIGINT),
walk AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k, before, behind FROM (
    SELECT r, step, coalesce(string_agg(node, '' ORDER BY slot) FILTER (slot < pos), '') AS before, coalesce(string_agg(node, '' ORDER BY slot) FILTER (slot > pos), '') AS behind
    FROM (SELECT *, max(slot) FILTER (mine) OVER (PARTITION BY r, step) AS pos FROM steps) GROUP BY r, step)),
fold(r, k, node) AS (
    SELECT r, 0, coalesce(other, leaf) FROM rows
    UNION ALL
    SELECT w.r, f.k + 1, sha256(w.before || f.node || w.behind) FROM fold f JOIN walk w ON w.r = f.r AND w.k = f.k + 1)
SELECT d.doc_id, d.leaf, d.subroot, root.node AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root.node AS verified
FROM rows d LEFT JOIN (SELECT r, string_agg(before || behind, '' ORDER BY k) AS proof FROM walk GROUP BY r) p ON p.r = d.r
JOIN (SELECT r, max_by(node, k) AS node FROM fold GROUP BY r) f ON f.r = d.r
CROSS JOIN (SELECT max_by(node, level) AS node FROM upper) root
"""
