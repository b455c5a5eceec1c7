"""The whole run: land, refine, check, publish, compute KPIs, check them, reconcile, and monitor whatever happened."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import functions as F

from .. import ops
from ..operators import kpis, quality
from ..sources import ingest
from . import checks, gold, reconciliation, silver

SUCCEEDED, FAILED, SKIPPED = "Succeeded", "Failed", "Skipped"


@dataclass(frozen=True)
class Activity:
    """work(line) gets the line of the run log to fill in. It runs if the activity before ended in one of these ways."""

    name: str
    work: Callable[[dict], object]
    after: Collection[str] = (SUCCEEDED,)
    retries: int = 0
    logged: bool = True


def chain(catalog, batch: str, activities: list[Activity], wait: float = 0.0) -> dict[str, tuple[str, object]]:
    """Runs them in order: how each ended and what it returned. The first error is raised when all have had their turn."""
    ended: dict[str, tuple[str, object]] = {}
    state, first = SUCCEEDED, None
    for a in activities:
        if state not in a.after:
            state = SKIPPED
            ended[a.name] = (SKIPPED, None)
            continue

        def once(a=a):
            if not a.logged:
                return a.work({})
            with ops.logged_step(catalog, batch, a.name) as line:
                return a.work(line)

        try:
            ended[a.name], state = (SUCCEEDED, ops.attempts(once, a.retries, wait)), SUCCEEDED
        except Exception as error:
            ended[a.name], state, first = (FAILED, error), FAILED, first or error
    if first:
        raise first
    return ended


def kpi_frames(catalog):
    c = F.col
    month = F.last_day(F.to_date(c("date_key").cast("string"), "yyyyMMdd"))
    b = catalog.read("fact_balance_snapshot").select(month.alias("month_end"), c("country_code").alias("scope"), c("customer_id").alias("customer"), "balance_local", "balance_eur", c("fx_rate").alias("rate"), c("days_past_due").alias("dpd"), c("is_active").alias("active"))
    o = catalog.read("fact_origination").select(month.alias("month_end"), c("country_code").alias("scope"), "amount_local", "amount_eur", c("fx_rate_month_end").alias("rate_end"), c("fx_rate_avg").alias("rate_avg"))
    a = catalog.read("fact_application").select(month.alias("month_end"), c("country_code").alias("scope"), c("is_decisioned").alias("decisioned"), c("is_approved").alias("approved"))
    return b, o, a


def run(catalog, landing: str, batch: str, monitor: bool = True, retries: int = 0, reconcile: bool = False, as_of: datetime | None = None) -> dict:
    """Each step runs if the one before succeeded; monitoring runs in any case, and makes the run fail if an alert is critical."""

    def checked(name: str, what: list[quality.Check]):
        results = quality.evaluate(what, catalog.read)
        catalog.write(quality.result_frame(catalog.spark, results, name, batch, ops.now()), "dq_results", "append")
        quality.gate(results)
        return results

    def bronze(line: dict):
        done = ingest.bronze(catalog, landing, batch)
        line["rows"] = sum(done.values())
        return done

    def refined(line: dict):
        audit = silver.run(catalog, batch, ops.now())
        line["rows"] = sum(r[6] for r in audit)
        return audit

    activities = [
        Activity("bronze", bronze, retries=retries),
        Activity("silver", refined, retries=retries),
        Activity("silver_checks", lambda line: checked("silver", checks.SILVER)),
        Activity("gold", lambda line: gold.run(catalog, batch, checks.GOLD, ops.now())),
        Activity("kpis", lambda line: catalog.write(kpis.kpi_table(kpis.components(*kpi_frames(catalog))), checks.KPI), retries=retries),
        Activity("kpi_checks", lambda line: checked("kpi", checks.KPIS)),
    ]
    if reconcile:
        activities.append(Activity("reconciliation", lambda line: reconciliation.run(catalog)))
    if monitor:
        activities.append(Activity("monitoring", lambda line: ops.monitor(catalog, batch, as_of), (SUCCEEDED, FAILED, SKIPPED), logged=False))
    ended = chain(catalog, batch, activities)
    return {name: value for name, (_, value) in ended.items()} | {"alerts": ended.get("monitoring", (None, None))[1]}
