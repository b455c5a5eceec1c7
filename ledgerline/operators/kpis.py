"""KPI components by month and country, group totals, and the KPI table in all definition variants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from .relational import outer_zero, unpivot, with_total

# KPI names and their variants, from the legacy definition to the published one.
VARIANTS = {
    "portfolio_balance_eur": ["legacy_def", "new"],
    "new_originations_eur": ["legacy_def", "avg_rate", "new"],
    "new_accounts": ["legacy_def"],
    "dpd30_rate": ["legacy_def", "new"],
    "dpd90_rate": ["legacy_def", "new"],
    "approval_rate": ["legacy_def", "new"],
    "avg_balance_per_customer_eur": ["legacy_def", "per_customer", "new"],
}


def named(sums: Mapping[str, Column], prefix: str = "") -> list[Column]:
    return [value.alias(prefix + name) for name, value in sums.items()]


def balance_sums() -> dict[str, Column]:
    """Aggregates over active balances: customer, balance_local, balance_eur, rate, dpd."""
    local = F.col("balance_local") * F.col("rate")
    late = lambda days, value: F.sum(F.when(F.col("dpd") >= days, value).otherwise(F.lit(0)))
    return {
        "unrounded": F.sum(local), "balance": F.sum("balance_eur"), "late30": late(30, F.col("balance_eur")), "late90": late(90, F.col("balance_eur")),
        "late30_unrounded": late(30, local), "late90_unrounded": late(90, local), "accounts": F.count("*"), "customers": F.countDistinct("customer"),
    }


def balance_components(facts: DataFrame) -> DataFrame:
    """facts: month_end, scope, account, customer, balance_local, balance_eur, rate, dpd, active. Rows that are not active do not count."""
    return facts.where("active").groupBy("month_end", "scope").agg(*named(balance_sums()))


def origination_sums() -> dict[str, Column]:
    """Aggregates over accounts opened: amount_local, amount_eur, rate_end, rate_avg."""
    return {"opened": F.count("*"), "originated": F.sum("amount_eur"), "originated_end": F.sum(F.col("amount_local") * F.col("rate_end")), "originated_avg": F.sum(F.col("amount_local") * F.col("rate_avg"))}


def origination_components(facts: DataFrame) -> DataFrame:
    """facts: month_end, scope, amount_local, amount_eur, rate_end, rate_avg."""
    return facts.groupBy("month_end", "scope").agg(*named(origination_sums()))


def application_sums() -> dict[str, Column]:
    """Aggregates over applications: decisioned, approved."""
    return {"received": F.count("*"), "decisioned": F.count_if(F.expr("decisioned")), "approved": F.count_if(F.expr("approved"))}


def application_components(facts: DataFrame) -> DataFrame:
    """facts: month_end, scope, decisioned, approved."""
    return facts.groupBy("month_end", "scope").agg(*named(application_sums()))


def components(balances: DataFrame, originations: DataFrame, applications: DataFrame) -> DataFrame:
    """All components side by side, zero where a part has none, with the group's sums."""
    on = ["month_end", "scope"]
    both = outer_zero(outer_zero(balance_components(balances), origination_components(originations), on), application_components(applications), on)
    return with_total(both, "month_end", "scope")


def kpi_values(named: Mapping[str, str] | None = None) -> list[tuple[str, str, Column]]:
    """(kpi, variant, value) over a row of components; named: other names that components have in the row."""
    c = lambda name: F.col((named or {}).get(name, name))
    over = lambda a, b: ratio(c(a), c(b))
    return [
        ("portfolio_balance_eur", "legacy_def", c("unrounded")), ("portfolio_balance_eur", "new", c("balance")),
        ("new_originations_eur", "legacy_def", c("originated_end")), ("new_originations_eur", "avg_rate", c("originated_avg")), ("new_originations_eur", "new", c("originated")),
        ("new_accounts", "legacy_def", c("opened")),
        ("dpd30_rate", "legacy_def", over("late30_unrounded", "unrounded")), ("dpd30_rate", "new", over("late30", "balance")),
        ("dpd90_rate", "legacy_def", over("late90_unrounded", "unrounded")), ("dpd90_rate", "new", over("late90", "balance")),
        ("approval_rate", "legacy_def", over("approved", "received")), ("approval_rate", "new", over("approved", "decisioned")),
        ("avg_balance_per_customer_eur", "legacy_def", over("unrounded", "accounts")), ("avg_balance_per_customer_eur", "per_customer", over("unrounded", "customers")), ("avg_balance_per_customer_eur", "new", over("balance", "customers")),
    ]


def kpi_table(parts: DataFrame) -> DataFrame:
    """month_end, scope, kpi, variant, value; rates without a denominator are left out."""
    return unpivot(parts, ["month_end", "scope"], kpi_values())
