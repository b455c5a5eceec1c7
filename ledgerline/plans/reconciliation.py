"""The reconciliation run: the legacy pack recalculated from gold, walked to the new figures, recorded and reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import legacy, reconcile as rec
from ..operators.relational import month_ends, outer_zero, within_months
from ..sources import exports
from ..sources.ingest import COUNTRIES
from .checks import KPI, WINDOW

#: The country whose tab converts at a typed rate.
TYPED = COUNTRIES[2].code


def sheet(catalog) -> DataFrame:
    """The sums of the legacy pack: active balances by product line and bucket, accounts opened, applications; rates by month and
    currency from the rate table."""
    read, c = catalog.read, F.col
    active = legacy.product_lines(read("fact_balance_snapshot").where("is_active"), read("dim_product"))
    rows = active.select(F.last_day("snapshot_date").alias("month_end"), c("country_code").alias("scope"), "line", c("product_code").alias("product"), c("dpd_bucket").alias("bucket"), c("balance_local").alias("balance"))
    buckets = catalog.spark.createDataFrame([(label, low) for label, low, _ in fn.DPD_BUCKETS], "bucket string, dpd_min int")
    by = lambda day: [F.last_day(day).alias("month_end"), c("country_code").alias("scope")]
    opened = read("fact_origination").groupBy(*by("open_date")).agg(F.count("*").alias("opened"), F.sum("amount_local").alias("disbursed"))
    asked = read("fact_application").groupBy(*by("application_date")).agg(F.count("*").alias("received"), F.count_if("is_approved").alias("approved"))
    rates = read("fx_rate_monthly").select("month_end", c("currency").alias("ccy"), c("rate_to_eur_month_end").alias("rate_end"))
    places = catalog.spark.createDataFrame([(x.code, x.currency) for x in COUNTRIES], "scope string, ccy string")
    sums = legacy.cube(rows, buckets).groupBy(*legacy.SHEET).agg(*legacy.balance_sums())
    return legacy.sheet(sums, rates, places, outer_zero(opened, asked, legacy.SHEET))


def run(catalog, out: str | None = None, window: tuple[str, str] = WINDOW, expected_cells: dict[str, int] | None = None) -> dict:
    """Writes recon_bridge, recon_attribution, recon_findings_summary, recon_diagnosis and recon_trail, and with `out` the same
    as CSV with a summary and the findings as text. A mended fault that changes no cell stops it. The headline numbers."""
    months = month_ends(*window)
    rows = within_months(sheet(catalog), months)
    legacy.require_cells(rows, expected_cells, TYPED)
    catalog.write(rec.bridge(legacy.figures(rows, TYPED), within_months(catalog.read(KPI), months)), "recon_bridge")
    bridged = catalog.read("recon_bridge")
    catalog.write(rec.attribution(bridged), "recon_attribution")
    tables = {"recon_findings_summary": rec.findings(bridged), "recon_diagnosis": rec.diagnose(rec.difference_profile(bridged)), "recon_trail": rec.peeling_trail(bridged)}
    for name, df in tables.items():
        catalog.write(df, name)
    numbers = rec.headline(bridged).first().asDict() | {"bridge_rows_that_do_not_close": rec.not_closing(bridged).count()}
    if out:
        for name, order in (("bridge", rec.KEYS), ("attribution", [*rec.KEYS, "cause_id"]), ("findings_summary", ["cause_id"]), ("diagnosis", ["scope", "kpi"]), ("trail", ["round", "scope", "kpi"])):
            exports.csv_file(catalog.read(f"recon_{name}"), f"{out}/{name}.csv", order)
        exports.json_file(catalog.spark, numbers, f"{out}/reconciliation_summary.json")
        exports.text_file(catalog.spark, report(catalog, numbers), f"{out}/findings.md")
    return numbers


def _shown(value) -> str:
    return "" if value is None else f"{value:,.6g}" if isinstance(value, float) else str(value)


def _table(df: DataFrame, limit: int = 50) -> str:
    rows = [[_shown(v) for v in r] for r in df.limit(limit).collect()]
    lines = [df.columns, ["-"] * len(df.columns), *rows]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def walk(bridged: DataFrame, kpi: str = "portfolio_balance_eur", scope: str = "GROUP") -> list[tuple[str, float]]:
    """The last month's figure from legacy to new, step by step, steps within the tolerance left out."""
    r = bridged.where((F.col("kpi") == kpi) & (F.col("scope") == scope)).orderBy(F.col("month_end").desc()).limit(1).first()
    if r is None:
        return []
    step = lambda causes: [(f"{x.id} {x.title}", r[x.column]) for x in causes if r[x.column] is not None and abs(r[x.column]) > r["tolerance"]]
    return [("as published", r[rec.PUBLISHED]), *step(rec.FIXES), ("corrected", r["legacy_corrected"]), *step([rec.RESIDUAL]), *step(rec.CHANGES), ("new figure", r["gold_published"])]


def report(catalog, numbers: dict) -> str:
    """The findings as a Markdown page."""
    bridged, trail = catalog.read("recon_bridge"), catalog.read("recon_trail")
    parts = [
        "# Reconciliation findings", "\n".join(f"- {name.replace('_', ' ')}: {_shown(value)}" for name, value in numbers.items()),
        "## The group's balance in the last month", "\n".join(f"- {label}: {_shown(value)}" for label, value in walk(bridged)),
        "## Causes", _table(catalog.read("recon_findings_summary").drop("cause")),
        "## Largest differences", _table(rec.worst(bridged)),
        "## What was left after each mended fault", _table(rec.trail_highlights(trail)),
        "## Unexplained", _table(rec.unexplained(bridged).select(*rec.KEYS, "residual").orderBy(*rec.KEYS)),
    ]
    return "\n\n".join(parts) + "\n"
