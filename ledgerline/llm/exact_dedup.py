"""Exact deduplication as a stream with keyed state on disk.

A digest table (doc_id, digest of the normalised text, content locator) is written first and read as a file stream. The
locator is the file and the row in it that hold the text. A streaming aggregation keeps, for each digest and without expiry,
the row count and the stable identifier and locator of the copy that stays; its state lies in RocksDB and is checkpointed in
the shared folder, so a lost executor costs one micro-batch. Counts and identifiers only grow, so of the updates written for
a digest the one with the largest count is its last state.

The rows of a digest that was hit more than once are fetched by their locators and compared in full: equal texts have equal
smallest and largest text. The comparison is an aggregation, combined before the shuffle, so a group that holds a third of
the rows costs one row a task. Where texts differ under one digest, those rows are grouped by the whole text instead. Each
text is hashed once; what goes is removed by locator.

duplicates() judges one table by itself and drops its state; deliver() keeps the state under a folder of the caller and judges
one delivery after another.

Documents that do not come straight from Parquet files (other columns, filters and renamed ones do no harm) are written to
the shared folder first, where each row has a place.

Nulls: a null text is empty, and empty texts are equal. A null doc_id is smaller than any other. Of rows that repeat both
doc_id and text exactly one is kept. Other columns stay as they were, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ascii_lower, body, discard, scratch, small, stored

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no space is set aside in advance
}
FILES_PER_BATCH = 4096


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


LOCATOR = ["file", "at"]
#: Plans of one scan whose rows still stand for one row of a file each.
_PLAIN = ("LogicalRelation", "Project", "Filter", "SubqueryAlias", "View")


def located(docs: DataFrame) -> DataFrame:
    """__docs (all columns of docs as a struct), file, at: a struct, so that no column name can clash."""

    def placed(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("__docs"), meta["file_path"].alias("file"), meta["row_index"].alias("at"))

    plan, plain = docs._jdf.queryExecution().analyzed(), True
    while plain:
        plain = plan.getClass().getSimpleName() in _PLAIN
        if plan.children().isEmpty():
            break
        plan = plan.children().head()
    try:
        return placed(docs if plain else stored(docs, "docs"))
    except AnalysisException:  # files of a kind that has no row numbers
        return placed(stored(docs, "docs"))


def _normal() -> Column:
    return ascii_lower(body(F.col("__docs.text")))


def registry(digests: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """digest, n, keep (doc_id, file, at): the state after all files of digests, a written table."""
    session = digests.sparkSession.newSession()
    for key, value in ROCKSDB.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    log, checkpoint = scratch(session, "registry"), scratch(session, "state")
    source = session.readStream.schema(digests.schema).option("maxFilesPerTrigger", files_per_batch).parquet(digests._scratch)
    state = source.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", *LOCATOR)).alias("keep"))

    def append(batch: DataFrame, number: int) -> None:  # a batch that is run again replaces its own folder
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    query = state.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = digests.sparkSession
    discard(spark, checkpoint)
    kind = digests.select("digest", F.lit(0).cast("bigint").alias("n"), F.struct("doc_id", *LOCATOR).alias("keep")).schema
    batches = sum(p.numInputRows > 0 for p in query.recentProgress)
    if not batches:
        return spark.createDataFrame([], kind)
    updates = spark.read.schema(kind).option("basePath", log).parquet(f"{log}/batch=*").select("digest", "n", "keep")
    return updates if batches == 1 else updates.groupBy("digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep"))


class DigestCollision(RuntimeError):
    """Unlike texts under one digest, in a registry that lives on."""


def _text(spark: SparkSession, places: DataFrame) -> DataFrame:
    """digest, body of rows at places (digest, file, at) in files that were delivered before. Only the names of these files pass
    through the driver."""
    files = [r[0] for r in places.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], "digest binary, body string")
    rows = spark.read.schema("text string").parquet(*files)
    meta = rows.metadataColumn("_metadata")
    rows = rows.select(meta["file_path"].alias("file"), meta["row_index"].alias("at"), ascii_lower(body(rows["text"])).alias("body"))
    return rows.join(_places(places, F.col("digest").alias("__digest")), _at_places(rows)).select(F.col("__digest").alias("digest"), "body")


def _at_places(rows: DataFrame) -> Column:
    return (rows["file"] == F.col("__file")) & (rows["at"] == F.col("__at"))


def deliver(docs: DataFrame, state: str, delivery: str, digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The rows of one delivery judged against all deliveries so far: doc_id, keep_id, group_size (of all deliveries), kept, digest,
    file, at.

    The registry lives on in the folder `state`: digests by delivery, the stream's checkpoint with its keyed state on disk, and the
    updates that it wrote. A call reads only the digests of its own delivery; a delivery that is given again under its name adds
    nothing. In the stream, each digest that is hit has its texts fetched, those of this delivery and the one kept before, and
    compared in full before the update is written; unlike texts stop it with DigestCollision, as a registry by digest cannot hold
    both. docs has to come from Parquet files that stay where they are, as later deliveries are compared with them. kept is judged
    as of now: a later delivery may bring an equal text of a larger doc_id.
    """
    spark = docs.sparkSession
    rows = located(docs)
    folder = f"{state}/digests/delivery={delivery}"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        rows.select(F.col("__docs.doc_id").alias("doc_id"), digest(_normal()).alias("digest"), *LOCATOR).write.mode("overwrite").parquet(folder)
    own = spark.read.parquet(folder)

    def log() -> DataFrame:
        return spark.read.option("basePath", f"{state}/log").parquet(f"{state}/log/batch=*")

    def confirm(batch: DataFrame, number: int) -> None:
        hits = batch.where("n > 1").select("digest")
        mine = own.join(hits, "digest", "left_semi")
        kept = log().where(F.col("batch") < number).join(hits, "digest", "left_semi").groupBy("digest").agg(F.max("keep").alias("keep"))  # as it was
        before = kept.select("digest", F.col("keep.file").alias("file"), F.col("keep.at").alias("at")).join(own.select(*LOCATOR), LOCATOR, "left_anti")
        here = _places(mine, F.col("digest").alias("__digest"))
        texts = rows.join(here, _at(rows, here)).select(F.col("__digest").alias("digest"), _normal().alias("body")).unionByName(_text(spark, before))
        unlike = texts.groupBy("digest").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a <> b").select(F.hex("digest")).limit(3).collect()
        if unlike:
            raise DigestCollision(", ".join(r[0] for r in unlike))

    session = spark.newSession()
    for key, value in ROCKSDB.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    source = session.readStream.schema(own.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{state}/digests/delivery=*")
    known = source.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", *LOCATOR)).alias("keep"))

    def append(batch: DataFrame, number: int) -> None:
        path = f"{state}/log/batch={number}"
        batch.write.mode("overwrite").parquet(path)  # the update once, for the comparison and for later calls
        written = spark.read.parquet(path)
        try:
            confirm(written, number)
        except DigestCollision:
            discard(spark, path)
            raise

    known.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = log().join(own.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep"))
    kept = (F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at"))
    return own.join(last, "digest").select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), "digest", *LOCATOR)


def _at(left: DataFrame, right: DataFrame) -> Column:
    return (left["file"] == right["__file"]) & (left["at"] == right["__at"])


def _places(rows: DataFrame, *others: str) -> DataFrame:
    return small(rows.select(F.col("file").alias("__file"), F.col("at").alias("__at"), *others))


def _marks(docs: DataFrame, digest: Callable[[Column], Column], files_per_batch: int) -> DataFrame:
    """docs: located. doc_id, keep_id, group_size, kept, digest, file, at of each row, written."""
    digests = stored(docs.select(F.col("__docs.doc_id").alias("doc_id"), digest(_normal()).alias("digest"), *LOCATOR), "digests")
    known = registry(digests, files_per_batch)
    columns = ["doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), ((F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at"))).alias("kept"), "digest", *LOCATOR]
    marked = stored(digests.join(known, "digest").select(*columns), "marks")
    discard(docs.sparkSession, digests)

    hits = _places(marked.where("group_size > 1"), F.col("digest").alias("__digest"))
    fetched = docs.join(hits, _at(docs, hits)).select(F.col("__digest").alias("digest"), _normal().alias("body"))
    differ = stored(fetched.groupBy("digest").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a <> b").select("digest"), "collisions")
    if differ.isEmpty():
        return marked
    own = _places(marked.join(small(differ), "digest", "left_semi"), F.col("digest").alias("__digest"))
    apart = docs.join(own, _at(docs, own)).select(F.col("__docs.doc_id").alias("doc_id"), F.col("__digest").alias("digest"), _normal().alias("body"), *LOCATOR)
    groups = apart.groupBy("digest", "body").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", *LOCATOR)).alias("keep"))
    return marked.join(small(differ), "digest", "left_anti").select(*marked.columns).unionByName(apart.join(groups, ["digest", "body"]).select(*columns))


def duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """For each row of docs: doc_id, keep_id, group_size, kept, digest, file, at. Rows keep no order."""
    return _marks(located(docs), digest, files_per_batch)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts, that with the largest doc_id, all its columns as they were."""
    rows = located(docs)
    gone = _places(_marks(rows, sha256, FILES_PER_BATCH).where("NOT kept"))
    return rows.join(gone, _at(rows, gone), "left_anti").select("__docs.*")


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""
