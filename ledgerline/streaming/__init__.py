"""Incremental landing by file streams: each file is read exactly once, a rerun adds nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_new_files(source: DataFrame, target: str, checkpoint: str) -> int:
    """Appends what the streaming source has that was not there before, and stops; the rows appended."""
    query = source.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def with_lineage(stream: DataFrame, feed: str, batch: str) -> DataFrame:
    return stream.select("*", F.lit(feed).alias("_country_feed"), F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_source_modified_at"), F.current_timestamp().alias("_ingested_at"), F.lit(batch).alias("_batch_id"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where all runs on one machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return root or f"file://{tempfile.mkdtemp(prefix='ledgerline-')}"


def parquet_stream(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet at path as a stream: all files of a folder, or a file alone, whatever lies beside it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())


def land(spark: SparkSession, path: str, work: str | None = None, feed: str = "events") -> DataFrame:
    """Streams the Parquet at path into a landing table below work and returns the table."""
    work = work or f"{shared_folder(spark)}/land-{uuid.uuid4().hex[:12]}"
    append_new_files(with_lineage(parquet_stream(spark, path), feed, work.rsplit("/", 1)[-1]), f"{work}/table", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/table")
