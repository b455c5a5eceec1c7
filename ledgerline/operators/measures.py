"""Measures of the semantic layer: what a measure means, compiled to a plan for any grouping, with row-level security.

Stocks are semi-additive: in each group they are those of the last date with an active balance. Late balances take the same
date as the balance they are compared with. Measures of the month before shift the calendar, so a missing month gives null.

A measure can be grouped by columns of its fact and, through the relationships, by `dimension.column`: only dimensions that are
named, or that a role restricts, are joined. Facts are seen through the dimensions, so what a role may not see there is not
counted either.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    folder: str
    format: str
    table: str
    kind: str  # stock, shifted, ratio, flow
    sql: str  # an aggregate for stocks and flows, an expression over other measures for the rest
    hidden: bool = False

    @property
    def description(self) -> str:
        return DESCRIPTIONS[self.name]


BAL, ORI, APP, PAY = "fact_balance_snapshot", "fact_origination", "fact_application", "fact_repayment"
# Names, folders and formats that reports rely on.
MEASURES = [
    Measure("Portfolio balance (EUR)", "Portfolio", "#,0", BAL, "stock", "sum(if(is_active, balance_eur, null))"),
    Measure("Portfolio balance last month (EUR)", "Portfolio", "#,0", BAL, "shifted", "Portfolio balance (EUR)", True),
    Measure("Portfolio balance MoM %", "Portfolio", "0.0%", BAL, "ratio", "try_divide(`Portfolio balance (EUR)` - `Portfolio balance last month (EUR)`, `Portfolio balance last month (EUR)`)"),
    Measure("Active accounts", "Portfolio", "#,0", BAL, "stock", "count_if(is_active)"),
    Measure("Active customers", "Portfolio", "#,0", BAL, "stock", "count(distinct if(is_active, customer_id, null))"),
    Measure("Avg balance per customer (EUR)", "Portfolio", "#,0", BAL, "ratio", "try_divide(`Portfolio balance (EUR)`, `Active customers`)"),
    Measure("Avg balance per account (EUR)", "Migration", "#,0", BAL, "ratio", "try_divide(`Portfolio balance (EUR)`, `Active accounts`)"),
    Measure("Balance 30+ DPD (EUR)", "Credit quality", "#,0", BAL, "stock", "coalesce(sum(if(is_dpd30, balance_eur, null)), 0)"),
    Measure("30+ DPD rate", "Credit quality", "0.00%", BAL, "ratio", "try_divide(`Balance 30+ DPD (EUR)`, `Portfolio balance (EUR)`)"),
    Measure("Balance 90+ DPD (EUR)", "Credit quality", "#,0", BAL, "stock", "coalesce(sum(if(is_dpd90, balance_eur, null)), 0)"),
    Measure("90+ DPD rate", "Credit quality", "0.00%", BAL, "ratio", "try_divide(`Balance 90+ DPD (EUR)`, `Portfolio balance (EUR)`)"),
    Measure("30+ DPD rate last month", "Credit quality", "0.00%", BAL, "shifted", "30+ DPD rate", True),
    Measure("30+ DPD rate change", "Credit quality", "+0.00%;-0.00%;0.00%", BAL, "ratio", "`30+ DPD rate` - `30+ DPD rate last month`"),
    Measure("New accounts", "Origination", "#,0", ORI, "flow", "count(1)"),
    Measure("New originations (EUR)", "Origination", "#,0", ORI, "flow", "sum(amount_eur)"),
    Measure("Avg loan size (EUR)", "Origination", "#,0", ORI, "ratio", "try_divide(`New originations (EUR)`, `New accounts`)"),
    Measure("Applications received", "Applications", "#,0", APP, "flow", "count(1)"),
    Measure("Applications decisioned", "Applications", "#,0", APP, "flow", "count_if(is_decisioned)"),
    Measure("Applications approved", "Applications", "#,0", APP, "flow", "count_if(is_approved)"),
    Measure("Approval rate", "Applications", "0.0%", APP, "ratio", "try_divide(`Applications approved`, `Applications decisioned`)"),
    Measure("Approval rate (legacy definition)", "Migration", "0.0%", APP, "ratio", "try_divide(`Applications approved`, `Applications received`)"),
    Measure("Repayments (EUR)", "Collections", "#,0", PAY, "flow", "sum(amount_eur)"),
    Measure("Quality checks run", "Trust", "#,0", "dq_results", "flow", "count(1)"),
    Measure("Quality checks failed", "Trust", "#,0", "dq_results", "flow", "count_if(NOT passed)"),
    Measure("Legacy error effect (EUR)", "Trust", "#,0", "recon_attribution", "flow", "sum(if(classification = 'LEGACY_ERROR' AND kpi = 'portfolio_balance_eur', amount, null))"),
    Measure("Unexplained differences", "Trust", "#,0", "recon_attribution", "flow", "count_if(classification = 'UNEXPLAINED')"),
]
BY_NAME = {m.name: m for m in MEASURES}
_LAST_DATE = "Of several dates, that of the last one on which any account in view was active."
#: What a reader of a report sees beside a measure.
DESCRIPTIONS = {
    "Portfolio balance (EUR)": f"What active accounts owe, each balance converted at its month-end rate. {_LAST_DATE}",
    "Portfolio balance last month (EUR)": "The portfolio balance at the end of the calendar month before; blank if that month has none.",
    "Portfolio balance MoM %": "Growth of the portfolio balance over the calendar month before.",
    "Active accounts": f"Accounts that are neither closed nor written off. {_LAST_DATE}",
    "Active customers": f"Customers with at least one active account, each once. {_LAST_DATE}",
    "Avg balance per customer (EUR)": "Portfolio balance over active customers.",
    "Avg balance per account (EUR)": "Portfolio balance over active accounts, as the old pack divided it; kept to compare with.",
    "Balance 30+ DPD (EUR)": f"The part of the balance that is 30 days or more past due. {_LAST_DATE}",
    "30+ DPD rate": "Balance 30 days or more past due as a share of the portfolio balance of the same date.",
    "Balance 90+ DPD (EUR)": f"The part of the balance that is 90 days or more past due. {_LAST_DATE}",
    "90+ DPD rate": "Balance 90 days or more past due as a share of the portfolio balance of the same date.",
    "30+ DPD rate last month": "The 30+ rate of the calendar month before.",
    "30+ DPD rate change": "The 30+ rate less that of the calendar month before, in points.",
    "New accounts": "Accounts opened in the period, by opening date.",
    "New originations (EUR)": "Amounts of the accounts opened, converted at the average rate of their month.",
    "Avg loan size (EUR)": "New originations over new accounts.",
    "Applications received": "All applications by date, decided or not.",
    "Applications decisioned": "Applications that were approved or declined.",
    "Applications approved": "Applications that were approved.",
    "Approval rate": "Approved applications over decided ones; pending and withdrawn ones do not count.",
    "Approval rate (legacy definition)": "Approved applications over all received, as the old pack had it; kept to compare with.",
    "Repayments (EUR)": "Payments received, converted at the average rate of their month.",
    "Quality checks run": "Results of checks that were recorded.",
    "Quality checks failed": "Recorded results that did not pass.",
    "Legacy error effect (EUR)": "What mended faults of the old pack change in the portfolio balance, added up.",
    "Unexplained differences": "Figures for which no fault and no definition accounts; should be zero.",
}


def _date(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


# Many to one, single direction; facts carry their own country and product, so dimensions are not joined to others.
RELATIONSHIPS = [
    ("fact_balance_snapshot", "date_key", "dim_date", "date_key"),
    ("fact_balance_snapshot", "account_id", "dim_account", "account_id"),
    ("fact_balance_snapshot", "customer_id", "dim_customer", "customer_id"),
    ("fact_balance_snapshot", "product_code", "dim_product", "product_code"),
    ("fact_balance_snapshot", "country_code", "dim_country", "country_code"),
    ("fact_origination", "date_key", "dim_date", "date_key"),
    ("fact_origination", "account_id", "dim_account", "account_id"),
    ("fact_origination", "customer_id", "dim_customer", "customer_id"),
    ("fact_origination", "product_code", "dim_product", "product_code"),
    ("fact_origination", "country_code", "dim_country", "country_code"),
    ("fact_application", "date_key", "dim_date", "date_key"),
    ("fact_application", "customer_id", "dim_customer", "customer_id"),
    ("fact_application", "product_code", "dim_product", "product_code"),
    ("fact_application", "country_code", "dim_country", "country_code"),
    ("fact_repayment", "date_key", "dim_date", "date_key"),
    ("fact_repayment", "account_id", "dim_account", "account_id"),
    ("fact_repayment", "customer_id", "dim_customer", "customer_id"),
    ("fact_repayment", "product_code", "dim_product", "product_code"),
    ("fact_repayment", "country_code", "dim_country", "country_code"),
    ("fx_rate_monthly", "month_end_key", "dim_date", "date_key"),
]
# Roles, the countries they may see, and the tables and columns that a role filters.
ROLES = {"Poland country manager": ["PL"], "Czech country manager": ["CZ"], "Romania country manager": ["RO"], "Group reporting": None}
SECURED = {"dim_country": "country_code", "dim_customer": "country_code", "dim_account": "country_code"}


def secured(df: DataFrame, allowed: Sequence[str] | None, column: str = "country_code") -> DataFrame:
    """The rows of these countries; None allows all."""
    return df if allowed is None else df.where(F.col(column).isin(list(allowed)))


class Model:
    """The star with what a role may see of it. An unknown role sees nothing."""

    def __init__(self, read: Callable[[str], DataFrame], role: str | None = "Group reporting", roles: Mapping[str, Sequence[str] | None] = ROLES, relationships: Sequence[tuple] = tuple(RELATIONSHIPS), secures: Mapping[str, str] = SECURED):
        self._read, self.allowed, self.relationships, self.secures = read, roles.get(role, ()), relationships, secures

    def table(self, name: str) -> DataFrame:
        """A table as the role sees it: dimensions by their own column, facts by theirs, or through the secured dimensions they point to."""
        df = self._read(name)
        if self.allowed is None:
            return df
        if name in self.secures:
            return secured(df, self.allowed, self.secures[name])
        links = [r for r in self.relationships if r[0] == name and r[2] in self.secures]
        own = next((self.secures[r[2]] for r in links if self.secures[r[2]] in df.columns), None)
        if own:  # the fact has the secured column itself: one filter, no join
            return secured(df, self.allowed, own)
        for fact, column, dimension, key in links:
            seen = self.table(dimension).select(F.col(key).alias("_seen"))
            df = df.join(seen, df[column] == F.col("_seen"), "left_semi")
        return df

    def joined(self, fact: str, attributes: Sequence[str]) -> DataFrame:
        """The fact with the attributes `dimension.column` as columns of that name, dots for underscores."""
        df = self.table(fact)
        for dimension in dict.fromkeys(a.split(".")[0] for a in attributes if "." in a):
            found = [(c, k) for f, c, d, k in self.relationships if f == fact and d == dimension]
            if not found:
                raise ValueError(f"{fact} has no relationship to {dimension}")
            column, key = found[0]
            wanted = [a.split(".")[1] for a in attributes if a.startswith(f"{dimension}.")]
            other = self.table(dimension).select(F.col(key).alias("_key"), *[F.col(c).alias(f"{dimension}_{c}") for c in wanted])
            df = df.join(other, df[column] == F.col("_key"), "left").drop("_key")
        return df

    def evaluate(self, name: str, by: Sequence[str] = (), months: bool = False) -> DataFrame:
        """The measure for each group of `by`, with months for each month end too. A shifted measure needs months."""
        return self.evaluate_many([name], by, months)

    def evaluate_many(self, names: Sequence[str], by: Sequence[str] = (), months: bool = False) -> DataFrame:
        """Several measures side by side, as evaluate_many gives them."""
        return evaluate_many(names, lambda table: self.joined(table, by), [b.replace(".", "_") for b in by], months)


def needed(names: Sequence[str]) -> list[Measure]:
    """The measures and all that they are made of, each after what it is made of."""
    order: dict[str, Measure] = {}

    def visit(name: str) -> None:
        if name in order:
            return
        m = BY_NAME[name]
        for part in [m.sql] if m.kind == "shifted" else [n for n in BY_NAME if f"`{n}`" in m.sql] if m.kind == "ratio" else []:
            visit(part)
        order[name] = m

    for name in names:
        visit(name)
    return list(order.values())


def _base(fact: DataFrame, own: Sequence[Measure], keys: Sequence[str]) -> list[DataFrame]:
    """The stocks and the flows of a fact: keys and a column each, from one aggregation of either kind."""
    value = lambda m: F.expr(m.sql).cast("double").alias(m.name)
    stocks, flows = ([m for m in own if m.kind == kind] for kind in ("stock", "flow"))
    out = [fact.groupBy(*keys).agg(*map(value, flows))] if flows else []
    if stocks:
        # the values of each date in context, then those of the last date with an active row
        dated = fact.groupBy(*keys, "date_key").agg(*map(value, stocks), F.count_if(F.expr("is_active")).alias("__active")).where("__active > 0")
        last = dated.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{m.name}`") for m in stocks]), "date_key").alias("__last"))
        out.append(last.select(*keys, "__last.*"))
    return out


def evaluate_many(names: Sequence[str], read: Callable[[str], DataFrame], by: Sequence[str] = (), months: bool = False) -> DataFrame:
    """The measures, a column each, for each group of `by` (columns of their facts), with months for each month end too.

    The measures are resolved to what they are made of. Each fact that any of these needs is read once and aggregated once, at
    the grain of its dates where stocks are asked for; the small results are stacked and brought together by their keys, so no
    fact is joined to another. Shifted measures move a month's values to the next row of the same result, ratios are expressions
    over its columns. A group has a row if any fact has rows of it; a month after the last only if a shifted measure is asked for.
    """
    plan, by = needed(names), list(by)
    keys = [*by, *(["month_end"] if months else [])]
    shifted = [m for m in plan if m.kind == "shifted"]
    if shifted and not months:
        raise ValueError(f"{shifted[0].name} needs months")
    base = [m for m in plan if m.kind in ("stock", "flow")]
    parts = []
    for table in dict.fromkeys(m.table for m in base):
        fact = read(table)
        if months:
            fact = fact.withColumn("month_end", F.last_day(_date(F.col("date_key"))))
        parts += _base(fact, [m for m in base if m.table == table], keys)
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    out = stacked if len(parts) == 1 else stacked.groupBy(*keys).agg(*[F.max(f"`{m.name}`").alias(m.name) for m in base])
    out = _derived(out, [m for m in plan if m.kind == "ratio" and not any(x.kind == "shifted" for x in needed([m.name]))])
    if shifted:
        out = _shifted(out, by, shifted, any(BY_NAME[n].kind == "shifted" for n in names))
        out = _derived(out, [m for m in plan if m.kind == "ratio" and m.name not in out.columns])
    return out.select(*keys, *[F.col(f"`{n}`") for n in names])


def _derived(df: DataFrame, ratios: Sequence[Measure]) -> DataFrame:
    for m in ratios:
        df = df.withColumn(m.name, F.expr(m.sql))
    return df


def _shifted(df: DataFrame, by: Sequence[str], shifted: Sequence[Measure], beyond: bool) -> DataFrame:
    """df (a row a group and month) with the values of the month before. Each row is laid out for its own month and for the next, and
    what meets there is one row: no window, no second reading. beyond: months that have only a month before stay."""
    own = [c for c in df.columns if c not in (*by, "month_end")]
    blank = lambda c: F.lit(None).cast("double").alias(c)
    here = F.struct(F.col("month_end"), F.lit(True).alias("__own"), *[F.col(f"`{c}`").cast("double").alias(c) for c in own], *[blank(m.name) for m in shifted])
    after = F.struct(F.last_day(F.add_months("month_end", 1)).alias("month_end"), F.lit(False).alias("__own"), *[blank(c) for c in own], *[F.col(f"`{m.sql}`").cast("double").alias(m.name) for m in shifted])
    laid = df.select(*by, F.explode(F.array(here, after)).alias("x")).select(*by, "x.*")
    met = laid.groupBy(*by, "month_end").agg(F.bool_or("__own").alias("__own"), *[F.max(f"`{c}`").alias(c) for c in [*own, *[m.name for m in shifted]]])
    return (met if beyond else met.where("__own")).drop("__own")


def evaluate(name: str, read: Callable[[str], DataFrame], by: Sequence[str] = (), months: bool = False) -> DataFrame:
    """One measure, as evaluate_many gives it."""
    return evaluate_many([name], read, by, months)
