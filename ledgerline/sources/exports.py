"""What leaves the catalog as small files: tables as CSV, summaries as JSON, text. Written through Spark's file systems."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame

from .catalog import Files

MOST = 1_000_000

class TooLarge(ValueError):
    """More rows than one file of a report may have; such a table is written with Spark."""


def csv_file(df: DataFrame, path: str, order: Sequence[str] = (), most: int = MOST) -> int:
    """Writes a table of report size as one CSV file with a header, rows in this order; their number. More than `most` rows are refused
    before any is fetched."""
    if df.limit(most + 1).count() > most:
        raise TooLarge(f"{path} would have more than {most} rows")
    rows = (df.orderBy(*order) if order else df).toLocalIterator()
    text = io.StringIO()
    out, n = csv.writer(text, lineterminator="\n"), 0
    out.writerow(df.columns)
    for n, row in enumerate(rows, 1):
        out.writerow(["" if v is None else v for v in row])
    Files(df.sparkSession).swap(path, text.getvalue())
    return n


def json_file(spark, value, path: str) -> None:
    Files(spark).swap(path, json.dumps(value, indent=2, default=str, sort_keys=True) + "\n")


def text_file(spark, text: str, path: str) -> None:
    Files(spark).swap(path, text)


def kpi_csv(catalog, path: str, table: str = "gold_kpi_monthly") -> int:
    """The KPI table by month, scope, KPI and variant."""
    keys = ["month_end", "scope", "kpi", "variant"]
    return csv_file(catalog.read(table).select(*keys, "value"), path, keys)
