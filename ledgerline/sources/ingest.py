"""Landing of delivered files: each file exactly once, all columns as text, with lineage and a log."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.relational import union
from ..streaming import with_lineage

LOG = "ops_ingestion_log"


@dataclass(frozen=True)
class Country:
    code: str
    name: str
    currency: str
    decimal: str
    dates: str

    @property
    def separator(self) -> str:
        return ";" if self.decimal == "," else ","


# Countries with the locale of their files.
COUNTRIES = [Country("PL", "Poland", "PLN", ".", "%Y-%m-%d"), Country("CZ", "Czech Republic", "CZK", ",", "%Y-%m-%d"), Country("RO", "Romania", "RON", ".", "%d/%m/%Y")]
ENTITIES = ["customers", "accounts", "balances", "repayments"]
REFERENCES = {"products": "reference/products", "fx_rates": "treasury/fx_rates"}


@dataclass(frozen=True)
class Feed:
    """Files that come into one bronze table. separator by the code of the feed; None: lines of text. The code is that of the country
    whose folder a file lies in, or GROUP."""

    table: str
    folder: str  # a pattern
    suffix: str
    separators: Mapping[str, str | None]

    def code(self, path: str) -> str:
        return next((part for part in reversed(path.split("/")) if part in self.separators), "GROUP")


FEEDS = [
    *[Feed(f"bronze_{name}", folder, ".csv", {"GROUP": ","}) for name, folder in REFERENCES.items()],
    *[Feed(f"bronze_{name}", f"core_banking/{{{','.join(c.code for c in COUNTRIES)}}}/{name}", ".csv", {c.code: c.separator for c in COUNTRIES}) for name in ENTITIES],
    Feed("bronze_applications", "los/applications", ".jsonl", {"GROUP": None}),
]

CORRUPT = "_corrupt_record"
FILES_PER_BATCH = 1000
NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def parsed(catalog, files: Mapping[str, Sequence[str]], separator: str | None) -> list[DataFrame]:
    """Frames of text columns, one for each header among the files (keys: headers as delivered). A row with more or fewer fields than
    its header stays, and is kept whole in CORRUPT too."""
    read = catalog.spark.read
    if separator is None:
        return [read.text(list(paths)).withColumnRenamed("value", "raw_json") for paths in files.values()]
    frames = []
    for header, paths in files.items():
        names = next(csv.reader([header], delimiter=separator), [])
        kind = StructType([StructField(n.strip(), StringType()) for n in [*names, CORRUPT]])
        frames.append(read.schema(kind).option("header", True).option("sep", separator).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(list(paths)))
    return frames


def arrival(catalog, feed: Feed, files: Sequence[str], batch: str) -> DataFrame:
    """The rows of new files with their lineage. Files are read by their own header, so columns may stand in another order; one that a
    file lacks is null there, one that others lack is kept."""
    frames = []
    for code, separator in feed.separators.items():
        by_header: dict[str, list[str]] = {}
        for path in files:
            if feed.code(path) == code:
                by_header.setdefault("" if separator is None else catalog.files.first_line(path), []).append(path)
        frames += [with_lineage(df, code, batch) for df in parsed(catalog, by_header, separator)]
    return union(frames)


def land(catalog, feed: Feed, landing: str, batch: str) -> int:
    """Appends what a feed has that no call has seen, and the number of rows.

    A file stream over names alone keeps, in its checkpoint, which files have come; their contents are read by the batch that
    brings them and never again. A batch is appended under a version that carries its number, and its log likewise, so a batch
    that is run again after a crash finds what is there and adds the rest.
    """
    if not catalog.files.matches(f"{landing}/{feed.folder}"):
        return 0
    work = f"{catalog.work()}/{feed.table}"
    rows = []

    def append(names: DataFrame, number: int) -> None:
        files = [r["path"] for r in names.select("path").collect()]  # at most FILES_PER_BATCH
        if not files:
            return
        version = f"batch-{number:09d}"
        catalog.append(arrival(catalog, feed, files, batch), feed.table, version)
        counts = catalog.read_version(feed.table, version).groupBy("_source_file").agg(F.count("*").alias("row_count"))
        log = counts.select(F.lit(batch).alias("batch_id"), F.lit(feed.table).alias("table_name"), F.col("_source_file").alias("source_file"), "row_count", F.current_timestamp().alias("ingested_at"))
        catalog.append(log, LOG, f"{feed.table}-{version}")
        rows.append(catalog.read_version(LOG, f"{feed.table}-{version}").agg(F.sum("row_count")).first()[0] or 0)

    names = catalog.spark.readStream.format("binaryFile").schema(NAMES).option("pathGlobFilter", f"*{feed.suffix}").option("maxFilesPerTrigger", FILES_PER_BATCH).load(f"{landing}/{feed.folder}").select("path")
    names.writeStream.foreachBatch(append).option("checkpointLocation", work).trigger(availableNow=True).start().awaitTermination()
    return sum(rows)


def bronze(catalog, landing: str, batch: str) -> dict[str, int]:
    """Lands all feeds; the rows of each that were new."""
    return {feed.table.removeprefix("bronze_"): land(catalog, feed, landing.rstrip("/"), batch) for feed in FEEDS}
