"""The legacy pack as relational formulas, with its faults as switches, and the extracts it was fed with.

All figures follow from one small sheet, a row a month and country, which is summed in a single pass over the cube or the facts;
rates are looked up by month and currency. The pack as found and the same with one fault after another mended are columns of
that sheet, so no stage costs a scan of its own.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio_or_zero, sum_if
from .relational import measured, outer_zero, previous_month

FAULTS = ("F1", "F2", "F3")
FIXED_RATE = 0.2012  # fixed value: the rate typed into the third country's tab
STAGES = ["legacy_published", *[f"legacy_after_{f}" for f in FAULTS]]
SHEET = ["month_end", "scope"]


class FixDidNotApply(RuntimeError):
    """A mended fault changes another number of cells than it should: the pack is not the one the fault was found in."""


def cube(facts: DataFrame, buckets: DataFrame) -> DataFrame:
    """month_end, scope, line, product, dpd_min, accounts, balance (cents); facts carry a bucket label, buckets the lower bound of
    each label."""
    totals = facts.groupBy(*SHEET, "line", "product", "bucket").agg(F.count("*").alias("accounts"), F.sum("balance").cast("decimal(38,2)").alias("balance"))
    return totals.join(measured(buckets), "bucket").drop("bucket")


def balance_sums(late: str = "dpd_min", count: Column | None = None) -> list[Column]:
    """What the country tabs sum over balances: over the cells of a cube, or with the days past due as `late` and a count over facts."""
    c, money = F.col, "decimal(28,2)"
    return [
        *[sum_if("balance", test).cast(money).alias(name) for name, test in (("loans", c("line") == "Personal Loans"), ("cards_by_code", c("product").startswith("CC")), ("cards_by_line", c("line") == "Credit Cards"), ("late30", c(late) >= 30), ("late90", c(late) >= 90))],
        F.sum("balance").cast(money).alias("all_local"), (F.sum("accounts") if count is None else count).alias("accounts"),
    ]


FLOWS = ("opened", "disbursed", "received", "approved")


def rated(rows: DataFrame, rates: DataFrame, scopes: DataFrame) -> DataFrame:
    """rows with the rate of their month and currency: month_end, ccy, rate_end, one row each; scopes: scope, ccy. Where the month, the
    currency or the scope is not found the rate is null, and so is every figure that is converted by it."""
    table = rates.select("month_end", "ccy", F.col("rate_end").cast("decimal(18,8)").alias("rate"))
    return rows.join(measured(scopes), "scope", "left").join(measured(table), ["month_end", "ccy"], "left").drop("ccy")


def unrated(rows: DataFrame) -> DataFrame:
    """month_end, scope where the lookup found no rate: the cells of the pack that are no numbers."""
    return rows.where("rate IS NULL").select(*SHEET)


def sheet(sums: DataFrame, rates: DataFrame, scopes: DataFrame, flows: DataFrame | None = None) -> DataFrame:
    """A row a month and country: the sums that the country tabs are made of, and the rate that is looked up. sums: month_end, scope,
    balance_sums and whatever else is carried along; flows: month_end, scope and some of FLOWS. Missing sums are zero."""
    rows = sums if flows is None else outer_zero(sums, flows, SHEET)
    rows = rows.withColumns({n: F.lit(0).cast("decimal(28,2)") for n in FLOWS if n not in rows.columns})
    rows = previous_month(rows, "month_end", ["scope"], "late30", "late30_before").fillna(0, ["late30_before"])
    return rated(rows, rates, scopes)


# The figures of the pack.
KPIS = ["portfolio_balance_eur", "new_accounts", "new_originations_eur", "dpd30_rate", "dpd90_rate", "approval_rate", "avg_balance_per_customer_eur"]
BALANCE, WEIGHTED = KPIS[0], ("dpd30_rate", "dpd90_rate")


def formulas(fixed: Collection[str] = (), fixed_rate_scope: str = "") -> dict[str, Column]:
    """The figures of a country's tab over a row of the sheet. `fixed` names the faults that are mended.

    F1: the second addend of the total sums products by a name prefix instead of by line. F2: one country converts at a typed
    rate. F3: the 30+ numerator is that of the month before.
    """
    c = F.col
    typed = F.when(c("scope") == fixed_rate_scope, F.lit(FIXED_RATE).cast("decimal(18,8)")).otherwise(c("rate"))
    rate = (c("rate") if "F2" in fixed else typed).cast("double")
    balance = (c("loans") + (c("cards_by_line") if "F1" in fixed else c("cards_by_code"))).cast("double") * rate
    return {
        BALANCE: balance, "new_accounts": c("opened").cast("double"), "new_originations_eur": c("disbursed").cast("double") * rate,
        "dpd30_rate": ratio_or_zero(c("late30") if "F3" in fixed else c("late30_before"), "all_local"), "dpd90_rate": ratio_or_zero("late90", "all_local"),
        "approval_rate": ratio_or_zero("approved", "received"), "avg_balance_per_customer_eur": F.when(balance.isNotNull(), ratio_or_zero(balance, "accounts")),
    }


def group_formulas(figures: dict[str, Column]) -> dict[str, Column]:
    """The figures of the group tab as aggregates of the country tabs' figures: sums, and rates weighted by balance. As in a
    spreadsheet, a figure is no number if one that it is made of is none."""

    def total(x: Column) -> Column:
        return F.when(F.count_if(x.isNull()) == 0, F.sum(x))

    balance = total(figures[BALANCE])
    out = {name: total(figures[name]) for name in (BALANCE, "new_accounts", "new_originations_eur")}
    out |= {name: F.when(balance.isNotNull(), ratio_or_zero(total(figures[name] * figures[BALANCE]), balance)) for name in WEIGHTED}
    return out | {"approval_rate": ratio_or_zero(F.sum("approved"), F.sum("received")), "avg_balance_per_customer_eur": F.when(balance.isNotNull(), ratio_or_zero(balance, F.sum("accounts")))}


def tab(rows: DataFrame, fixed: Collection[str] = (), fixed_rate_scope: str = "") -> DataFrame:
    """The country tabs."""
    return rows.select(*SHEET, "accounts", "received", "approved", *[value.alias(name) for name, value in formulas(fixed, fixed_rate_scope).items()])


def summary(tabs: DataFrame) -> DataFrame:
    """The group tab."""
    added = [F.sum(name).alias(name) for name in ("accounts", "received", "approved")]
    return tabs.groupBy("month_end").agg(F.lit("GROUP").alias("scope"), *added, *[value.alias(name) for name, value in group_formulas({k: F.col(k) for k in KPIS}).items()])


def stages() -> list[tuple[str, frozenset]]:
    """The faulty pack and the same with one fault after another mended."""
    return [(name, frozenset(FAULTS[:k])) for k, name in enumerate(STAGES)]


def figures(rows: DataFrame, fixed_rate_scope: str = "", carried: Collection[str] = (), beside: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """month_end, scope (countries and GROUP), kpi, and a column for each stage, in one pass over the sheet.

    Each row has the figures of all stages as columns; countries and group come from one aggregation by grouping sets, and a
    single explode makes rows of the figures. Columns `carried` are summed along, and `beside` gives further columns by KPI, as
    expressions over them. A figure that is no number stays, as null.
    """
    beside = beside or {}
    of_row = {name: formulas(fixed, fixed_rate_scope) for name, fixed in stages()}
    wide = rows.select(*SHEET, "accounts", "received", "approved", *carried, *[v.alias(f"{s}.{k}") for s, own in of_row.items() for k, v in own.items()])
    single = F.grouping("scope") == 0
    sums = [F.sum(c).alias(c) for c in carried]
    for s in of_row:
        own = {k: F.col(f"`{s}.{k}`") for k in KPIS}
        sums += [F.when(single, F.first(own[k])).otherwise(value).alias(f"{s}.{k}") for k, value in group_formulas(own).items()]
    both = wide.groupingSets([SHEET, SHEET[:1]], *SHEET).agg(*sums)
    more = list(dict.fromkeys(n for own in beside.values() for n in own))
    values = [F.struct(F.lit(k).alias("kpi"), *[F.col(f"`{s}.{k}`").alias(s) for s in STAGES], *[beside.get(k, {}).get(n, F.lit(None)).cast("double").alias(n) for n in more]) for k in KPIS]
    return both.select("month_end", F.coalesce("scope", F.lit("GROUP")).alias("scope"), F.explode(F.array(*values)).alias("x")).select(*SHEET, "x.*")


def cells_changed(rows: DataFrame, fixed_rate_scope: str = "") -> DataFrame:
    """fault, kpi, cells: how many cells of the country tabs have another value, or none where they had one, once a fault is mended
    after those before it. A row for each fault and figure, zeros included."""
    pairs = [(f, k, formulas(FAULTS[:n], fixed_rate_scope)[k], formulas(FAULTS[: n + 1], fixed_rate_scope)[k]) for n, f in enumerate(FAULTS) for k in KPIS]
    counts = rows.agg(*[F.count_if(~before.eqNullSafe(after)).alias(f"{f}.{k}") for f, k, before, after in pairs])
    cells = F.array(*[F.struct(F.lit(f).alias("fault"), F.lit(k).alias("kpi"), F.col(f"`{f}.{k}`").alias("cells")) for f, k, *_ in pairs])
    return counts.select(F.explode(cells).alias("x")).select("x.*")


def require_cells(rows: DataFrame, expected: Mapping[str, int] | None = None, fixed_rate_scope: str = "") -> dict[str, int]:
    """The cells that each mended fault changes. One that changes none, or another number than expected, is refused."""
    found = {r["fault"]: r["n"] for r in cells_changed(rows, fixed_rate_scope).groupBy("fault").agg(F.sum("cells").alias("n")).collect()}
    wrong = [f"{f} changes no cell" for f in FAULTS if not found[f]]
    wrong += [f"{f} changes {found[f]} cells, expected {n}" for f, n in (expected or {}).items() if found[f] and found[f] != n]
    if wrong:
        raise FixDidNotApply("; ".join(wrong))
    return found


def product_lines(df: DataFrame, products: DataFrame, code: str = "product_code") -> DataFrame:
    """df with the line of its product; a code that is not in the list is UNMAPPED."""
    names = measured(products.select(F.col("product_code").alias("_code"), F.col("product_line").alias("line")))
    return df.join(names, df[code] == F.col("_code"), "left").drop("_code").fillna("UNMAPPED", ["line"])


def wide_rates(rates: DataFrame, currencies: Collection[str], value: str | Column = "rate_end") -> DataFrame:
    """month_end and a column for each currency."""
    v = F.col(value) if isinstance(value, str) else value
    return rates.groupBy("month_end").agg(*[F.max(F.when(F.col("ccy") == c, v)).alias(c) for c in currencies])


def monthly_path(daily: DataFrame, by: Collection[str], day: str, value: str) -> DataFrame:
    """Mean and last value of each month of a daily path: month_end, the keys, n, mean, last."""
    return daily.groupBy(F.last_day(day).alias("month_end"), *by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max_by(value, day).alias("last"))


def trailing(df: DataFrame, month: str, value: str, name: str, months: int = 12, keys: Collection[str] = ()) -> DataFrame:
    """df with the sum of the last so many months up to each; a month without a row adds nothing and takes a month's place.

    One row a month and key is meant. Without keys all months pass through one task, so these have to be monthly sums.
    """
    number = F.year(month) * 12 + F.month(month)
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(number).rangeBetween(1 - months, 0)))
