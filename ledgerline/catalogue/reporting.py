"""Legacy pack, bridge and findings, measures, row-level security, streaming ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import kpis
from ..operators import legacy as leg
from ..operators import measures as ms
from ..operators import reconcile as rec
from ..operators.relational import month_ends, unpivot, within_months
from .aggregates import balance_facts, orders_by_place
from .base import dbl, facts, query, rates, read, txt

_SCOPE = "AFRICA"


def pack_facts(spark, d):
    """Active balances for both sides. A country is a region here; the product line follows from the part, of which every third has a
    misleading prefix."""
    loan = F.col("l_partkey") % 3 != 0
    product = F.when(loan, F.when(F.col("l_partkey") % 7 == 0, F.lit("CC_CONSOL")).otherwise(F.lit("PL_STD"))).otherwise(F.lit("CC_GOLD"))
    named = dict(month_end="m", scope="r_name", balance="price", balance_local="price", balance_eur="eur", rate="rate_end", customer="o_custkey")
    return facts(spark, d).where("flag <> 'R'").select(*[F.col(c).alias(n) for n, c in named.items()], F.when(loan, F.lit("Personal Loans")).otherwise(F.lit("Credit Cards")).alias("line"), product.alias("product"), "bucket", "dpd")


def pack_rates(spark, d):
    """The rate table, and the currency of each region."""
    return rates(spark, d), read(spark, d, "region").select(F.col("r_name").alias("scope"), F.col("r_regionkey").cast("string").alias("ccy"))


def pack_sheet(spark, d):
    """The pack from a cube, without flows."""
    cells = leg.cube(pack_facts(spark, d), spark.createDataFrame([(b, low) for b, low, _ in fn.DPD_BUCKETS], "bucket string, dpd_min int"))
    return leg.sheet(cells.groupBy(*leg.SHEET).agg(*leg.balance_sums()), *pack_rates(spark, d))


def both_sides(spark, d, error: float = 0.0):
    """One row a month and region: the sheet of the pack, and beside it the components of the new model; orders are the accounts opened
    and the applications. With an error, one region's new balance of one month is wrong by so much, under both definitions."""
    gold = lambda sums: kpis.named(sums, rec.GOLD)
    sums = pack_facts(spark, d).groupBy(*leg.SHEET).agg(*leg.balance_sums("dpd", F.count("*")), *gold(kpis.balance_sums()))
    o = orders_by_place(spark, d).select(F.col("m").alias("month_end"), F.col("r_name").alias("scope"), F.col("total").alias("amount_local"), fn.to_eur("total", "rate_avg").alias("amount_eur"), "rate_end", "rate_avg", F.col("st").isin("F", "O").alias("decisioned"), (F.col("st") == "F").alias("approved"))
    flows = o.groupBy(*leg.SHEET).agg(*gold(kpis.origination_sums()), *gold(kpis.application_sums()), F.sum("amount_local").alias("disbursed"))
    flows = flows.withColumns({n: F.col(f"{rec.GOLD}{n}") for n in ("opened", "received", "approved")})
    rows = leg.sheet(sums, *pack_rates(spark, d), flows)
    if error:
        hit = (F.col("month_end") == F.lit("1997-03-31").cast("date")) & (F.col("scope") == "ASIA")
        rows = rows.withColumns({c: F.when(hit, F.col(c) + F.lit(str(error)).cast("decimal(10,2)")).otherwise(F.col(c)) for c in (f"{rec.GOLD}unrounded", f"{rec.GOLD}balance")})
    return rows


_SHEET = """, cells AS (SELECT m, r_name AS scope, sum(CASE WHEN l_partkey % 3 <> 0 THEN price ELSE 0 END) AS loans, sum(CASE WHEN l_partkey % 3 = 0 OR l_partkey % 7 = 0 THEN price ELSE 0 END) AS by_code, sum(CASE WHEN l_partkey % 3 = 0 THEN price ELSE 0 END) AS by_line,
sum(CASE WHEN dpd >= 30 THEN price ELSE 0 END) AS late30, sum(CASE WHEN dpd >= 90 THEN price ELSE 0 END) AS late90, sum(price) AS al, count(*) AS accounts FROM f WHERE flag <> 'R' GROUP BY m, r_name),
flows AS (SELECT m, r_name AS scope, count(*) AS opened, sum(total) AS disbursed, count(*) FILTER (WHERE st = 'F') AS approved FROM o JOIN pl ON o_custkey = c_custkey GROUP BY m, r_name),
fxr AS (SELECT m, r_name AS scope, ((200000 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(18,8) AS rate FROM (SELECT DISTINCT m FROM o), region),
sheet AS (SELECT j.*, x.rate, coalesce(b.late30, 0) AS before FROM
  (SELECT m, scope, coalesce(loans, 0) AS loans, coalesce(by_code, 0) AS by_code, coalesce(by_line, 0) AS by_line, coalesce(late30, 0) AS late30, coalesce(late90, 0) AS late90, coalesce(al, 0) AS al, coalesce(accounts, 0) AS accounts, coalesce(opened, 0) AS opened, coalesce(disbursed, 0) AS disbursed, coalesce(approved, 0) AS approved FROM cells FULL JOIN flows USING (m, scope)) j
  LEFT JOIN cells b ON b.scope = j.scope AND b.m = last_day(j.m - INTERVAL 1 MONTH) LEFT JOIN fxr x ON x.m = j.m AND x.scope = j.scope),
tabs AS (SELECT k, m, scope, accounts, opened, approved, (loans + CASE WHEN k >= 1 THEN by_line ELSE by_code END)::DOUBLE * (CASE WHEN k >= 2 OR scope <> 'AFRICA' THEN rate::DOUBLE ELSE 0.2012::DOUBLE END) AS balance, disbursed::DOUBLE * (CASE WHEN k >= 2 OR scope <> 'AFRICA' THEN rate::DOUBLE ELSE 0.2012::DOUBLE END) AS originated,
  coalesce((CASE WHEN k >= 3 THEN late30 ELSE before END)::DOUBLE / nullif(al, 0)::DOUBLE, 0) AS dpd30, coalesce(late90::DOUBLE / nullif(al, 0)::DOUBLE, 0) AS dpd90 FROM sheet, (VALUES (0), (1), (2), (3)) s(k))
"""


def _round(c):
    """Rates to nine digits, other figures to cents, without a negative zero."""
    return (F.when(F.col("kpi").endswith("_rate"), F.round(F.col(c), 9)).otherwise(F.round(F.col(c), 2)) + F.lit(0.0)).alias(c)


def _round_sql(c):
    return f"CASE WHEN kpi LIKE '%rate' THEN round({c}, 9) ELSE round({c}, 2) END + 0.0 AS {c}"


def _pack_query(name, k, fixed):
    sql = _SHEET + f"SELECT m::VARCHAR AS month_end, scope, balance AS balance_eur, dpd30 AS dpd30_rate, dpd90 AS dpd90_rate, accounts, balance / accounts AS avg_balance_eur FROM tabs WHERE k = {k} AND accounts > 0"

    def run(spark, d):
        t = leg.tab(pack_sheet(spark, d), fixed, _SCOPE)
        return t.select(txt("month_end").alias("month_end"), "scope", F.col("portfolio_balance_eur").alias("balance_eur"), "dpd30_rate", "dpd90_rate", F.col("accounts").cast("bigint").alias("accounts"), F.col("avg_balance_per_customer_eur").alias("avg_balance_eur"))

    run.__name__ = name
    query(sql)(run)


for _k, (_name, (_, _fixed)) in enumerate(zip(("legacy_pack_found", "legacy_pack_f1", "legacy_pack_f2", "legacy_pack_f3"), leg.stages())):
    _pack_query(_name, _k, _fixed)


@query(_SHEET + "SELECT m::VARCHAR AS month_end, round(sum(balance), 2) AS balance_eur, round(sum(dpd90 * balance) / sum(balance), 9) AS dpd90_rate, sum(accounts)::BIGINT AS accounts FROM tabs WHERE k = 0 AND accounts > 0 GROUP BY m")
def legacy_summary(spark, d):
    s = leg.summary(leg.tab(pack_sheet(spark, d), (), _SCOPE))
    return s.select(txt("month_end").alias("month_end"), F.round("portfolio_balance_eur", 2).alias("balance_eur"), F.round("dpd90_rate", 9).alias("dpd90_rate"), F.col("accounts").cast("bigint").alias("accounts"))


def component_frames(spark, d):
    """Balances, originations and applications of the testdata in the shape that the KPI components take; a country is a region."""
    b = balance_facts(spark, d, "r_name")
    o = orders_by_place(spark, d)
    amounts = o.select(F.col("m").alias("month_end"), F.col("r_name").alias("scope"), F.col("total").alias("amount_local"), fn.to_eur("total", "rate_avg").alias("amount_eur"), "rate_end", "rate_avg")
    return b, amounts, o.select(F.col("m").alias("month_end"), F.col("r_name").alias("scope"), F.col("st").isin("F", "O").alias("decisioned"), (F.col("st") == "F").alias("approved"))


_COMPONENTS = """, kb AS (SELECT m, r_name AS scope, sum(eur) AS balance, sum(price * rate_end) AS unrounded, sum(CASE WHEN dpd >= 30 THEN eur ELSE 0 END) AS late30, sum(CASE WHEN dpd >= 90 THEN eur ELSE 0 END) AS late90, sum(CASE WHEN dpd >= 30 THEN price * rate_end ELSE 0 END) AS late30u, sum(CASE WHEN dpd >= 90 THEN price * rate_end ELSE 0 END) AS late90u, count(*) AS accounts, count(DISTINCT o_custkey) AS customers FROM f WHERE flag <> 'R' GROUP BY m, r_name),
orr AS (SELECT *, ((200000 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6) AS re, ((200005 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6) AS ra FROM o JOIN pl ON o_custkey = c_custkey),
ko AS (SELECT m, r_name AS scope, count(*) AS opened, sum(round(total * ra, 2)::DECIMAL(18,2)) AS originated, sum(total * re) AS originated_end, sum(total * ra) AS originated_avg, count(*) AS received, count(*) FILTER (WHERE st IN ('F', 'O')) AS decisioned, count(*) FILTER (WHERE st = 'F') AS approved FROM orr GROUP BY m, r_name),
kc AS (SELECT m, scope, coalesce(balance, 0) AS balance, coalesce(unrounded, 0) AS unrounded, coalesce(late30, 0) AS late30, coalesce(late90, 0) AS late90, coalesce(late30u, 0) AS late30u, coalesce(late90u, 0) AS late90u, coalesce(accounts, 0) AS accounts, coalesce(customers, 0) AS customers, opened, originated, originated_end, originated_avg, received, decisioned, approved FROM ko LEFT JOIN kb USING (m, scope)),
kg AS (SELECT * FROM kc UNION ALL SELECT m, 'GROUP', sum(balance), sum(unrounded), sum(late30), sum(late90), sum(late30u), sum(late90u), sum(accounts), sum(customers), sum(opened), sum(originated), sum(originated_end), sum(originated_avg), sum(received), sum(decisioned), sum(approved) FROM kc GROUP BY m),
kv AS (SELECT * FROM (SELECT m AS month_end, scope, unnest([{'kpi': 'portfolio_balance_eur', 'variant': 'legacy_def', 'value': unrounded::DOUBLE}, {'kpi': 'portfolio_balance_eur', 'variant': 'new', 'value': balance::DOUBLE}, {'kpi': 'new_originations_eur', 'variant': 'legacy_def', 'value': originated_end::DOUBLE}, {'kpi': 'new_originations_eur', 'variant': 'avg_rate', 'value': originated_avg::DOUBLE}, {'kpi': 'new_originations_eur', 'variant': 'new', 'value': originated::DOUBLE}, {'kpi': 'new_accounts', 'variant': 'legacy_def', 'value': opened::DOUBLE},
  {'kpi': 'dpd30_rate', 'variant': 'legacy_def', 'value': late30u::DOUBLE / nullif(unrounded, 0)::DOUBLE}, {'kpi': 'dpd30_rate', 'variant': 'new', 'value': late30::DOUBLE / nullif(balance, 0)::DOUBLE}, {'kpi': 'dpd90_rate', 'variant': 'legacy_def', 'value': late90u::DOUBLE / nullif(unrounded, 0)::DOUBLE}, {'kpi': 'dpd90_rate', 'variant': 'new', 'value': late90::DOUBLE / nullif(balance, 0)::DOUBLE}, {'kpi': 'approval_rate', 'variant': 'legacy_def', 'value': approved::DOUBLE / nullif(received, 0)::DOUBLE}, {'kpi': 'approval_rate', 'variant': 'new', 'value': approved::DOUBLE / nullif(decisioned, 0)::DOUBLE},
  {'kpi': 'avg_balance_per_customer_eur', 'variant': 'legacy_def', 'value': unrounded::DOUBLE / nullif(accounts, 0)::DOUBLE}, {'kpi': 'avg_balance_per_customer_eur', 'variant': 'per_customer', 'value': unrounded::DOUBLE / nullif(customers, 0)::DOUBLE}, {'kpi': 'avg_balance_per_customer_eur', 'variant': 'new', 'value': balance::DOUBLE / nullif(customers, 0)::DOUBLE}], recursive := true) FROM kg) WHERE value IS NOT NULL)
"""


@query(_COMPONENTS + "SELECT m::VARCHAR AS month_end, scope, opened::BIGINT AS opened, originated::DOUBLE AS originated, originated_end::DOUBLE AS originated_end, received::BIGINT AS received, decisioned::BIGINT AS decisioned, approved::BIGINT AS approved, customers::BIGINT AS customers FROM kg")
def kpi_components(spark, d):
    k = kpis.components(*component_frames(spark, d))
    return k.select(txt("month_end").alias("month_end"), "scope", "opened", dbl("originated").alias("originated"), dbl("originated_end").alias("originated_end"), "received", "decisioned", "approved", "customers")


@query(_COMPONENTS + "SELECT month_end::VARCHAR AS month_end, scope, kpi, variant, value FROM kv")
def kpi_variants(spark, d):
    return kpis.kpi_table(kpis.components(*component_frames(spark, d))).withColumn("month_end", txt("month_end"))


def bridged(spark, d, error: float = 0.0):
    return rec.bridge_of(both_sides(spark, d, error), _SCOPE)


def _bridge_sql(components: str = _COMPONENTS) -> str:
    deltas = {"D1": ("portfolio_balance_eur", "new", "legacy_def"), "D2": ("new_originations_eur", "avg_rate", "legacy_def"), "D3": ("new_originations_eur", "new", "avg_rate"), "D4": ("dpd30_rate", "new", "legacy_def"), "D5": ("dpd90_rate", "new", "legacy_def"), "D6": ("approval_rate", "new", "legacy_def"), "D7": ("avg_balance_per_customer_eur", "per_customer", "legacy_def"), "D8": ("avg_balance_per_customer_eur", "new", "per_customer")}
    named = ", ".join(f"CASE WHEN kpi = '{k}' THEN coalesce(\"{a}\" - \"{b}\", 0) ELSE 0 END AS delta_{n}" for n, (k, a, b) in deltas.items())
    kinds = {"F1": ("LEGACY_ERROR", "legacy_formula"), "F2": ("LEGACY_ERROR", "legacy_formula"), "F3": ("LEGACY_ERROR", "legacy_formula")} | {n: ("DEFINITION_CHANGE", "definition" if n in ("D2", "D6", "D7") else "rounding") for n in deltas}
    parts = ", ".join(f"{{'cause_id': '{n}', 'classification': '{c}', 'kind': '{k}', 'amount': delta_{n}}}" for n, (c, k) in kinds.items()) + ", {'cause_id': 'U', 'classification': 'UNEXPLAINED', 'kind': 'residual', 'amount': residual}"
    figures = "unnest([{'kpi': 'portfolio_balance_eur', 'value': balance}, {'kpi': 'new_accounts', 'value': opened::DOUBLE}, {'kpi': 'new_originations_eur', 'value': originated}, {'kpi': 'dpd30_rate', 'value': dpd30}, {'kpi': 'dpd90_rate', 'value': dpd90}, {'kpi': 'approval_rate', 'value': coalesce(approved::DOUBLE / nullif(opened, 0)::DOUBLE, 0)}, {'kpi': 'avg_balance_per_customer_eur', 'value': coalesce(balance / nullif(accounts, 0)::DOUBLE, 0)}], recursive := true)"
    return components + _SHEET + f""", every_tab AS (SELECT k, m, scope, accounts, opened, approved, balance, originated, dpd30, dpd90 FROM tabs UNION ALL SELECT k, m, 'GROUP', sum(accounts), sum(opened), sum(approved), sum(balance), sum(originated), coalesce(sum(dpd30 * balance) / nullif(sum(balance), 0), 0), coalesce(sum(dpd90 * balance) / nullif(sum(balance), 0), 0) FROM tabs GROUP BY k, m),
fl AS (SELECT k, m AS month_end, scope, {figures} FROM every_tab),
fw AS (SELECT month_end, scope, kpi, max(value) FILTER (WHERE k = 0) AS legacy_published, max(value) FILTER (WHERE k = 1) AS s1, max(value) FILTER (WHERE k = 2) AS s2, max(value) FILTER (WHERE k = 3) AS s3 FROM fl WHERE value IS NOT NULL GROUP BY month_end, scope, kpi),
vw AS (SELECT month_end, scope, kpi, avg(value) FILTER (WHERE variant = 'legacy_def') AS legacy_def, avg(value) FILTER (WHERE variant = 'new') AS "new", avg(value) FILTER (WHERE variant = 'avg_rate') AS avg_rate, avg(value) FILTER (WHERE variant = 'per_customer') AS per_customer FROM kv GROUP BY month_end, scope, kpi),
bg AS (SELECT *, coalesce(legacy_def, CASE WHEN s3 = 0 THEN 0 END) AS gold_legacy FROM fw LEFT JOIN vw USING (month_end, scope, kpi)),
bp AS (SELECT *, coalesce(CASE WHEN kpi = 'new_accounts' THEN legacy_def ELSE "new" END, CASE WHEN gold_legacy = 0 THEN 0 END) AS gold_published FROM bg),
br AS (SELECT * EXCLUDE (legacy_def), gold_legacy AS legacy_def, s1 - legacy_published AS delta_F1, s2 - s1 AS delta_F2, s3 - s2 AS delta_F3, gold_legacy - s3 AS residual, {named}, gold_published - legacy_published AS total_difference,
  CASE WHEN kpi LIKE '%\\_rate' ESCAPE '\\' THEN 1e-7 WHEN kpi LIKE '%\\_eur' ESCAPE '\\' THEN 0.10 ELSE 0.5 END AS tolerance FROM bp),
att AS (SELECT * FROM (SELECT month_end, scope, kpi, tolerance, legacy_published, unnest([{parts}], recursive := true) FROM br) WHERE coalesce(abs(amount) > tolerance, classification = 'UNEXPLAINED'))
"""


_BR = _bridge_sql()
_SHOWN = ["legacy_published", "delta_F1", "delta_F2", "delta_F3", "residual", "delta_D1", "delta_D2", "delta_D6", "delta_D7", "total_difference"]


@query(_BR + "SELECT month_end::VARCHAR AS month_end, scope, kpi, " + ", ".join(map(_round_sql, _SHOWN)) + ", gold_published FROM br")
def bridge(spark, d):
    return bridged(spark, d).select(txt("month_end").alias("month_end"), "scope", "kpi", *[_round(c) for c in _SHOWN], "gold_published")


@query(_BR + "SELECT 'F' || b.k AS fault, kpi, count(*) FILTER (WHERE a.value IS DISTINCT FROM b.value) AS cells FROM fl a JOIN fl b USING (month_end, scope, kpi) WHERE b.k = a.k + 1 AND scope <> 'GROUP' GROUP BY b.k, kpi")
def cells_changed(spark, d):
    return leg.cells_changed(both_sides(spark, d), _SCOPE)


@query(_BR + "SELECT month_end::VARCHAR AS month_end, scope, kpi, cause_id, classification, kind, " + _round_sql("amount") + " FROM att")
def attribution(spark, d):
    return rec.attribution(bridged(spark, d)).select(txt("month_end").alias("month_end"), "scope", "kpi", "cause_id", "classification", "kind", _round("amount"))


@query(_BR + "SELECT count(*) FILTER (WHERE coalesce(abs(residual) > tolerance, true)) AS unexplained, count(*) FILTER (WHERE coalesce(abs(total_difference - (delta_F1 + delta_F2 + delta_F3 + residual + delta_D1 + delta_D2 + delta_D3 + delta_D4 + delta_D5 + delta_D6 + delta_D7 + delta_D8)) > tolerance, true)) AS open FROM br")
def unexplained(spark, d):
    b = bridged(spark, d).withColumns({"_u": rec.is_unexplained(), "_o": rec.is_open()})
    return b.agg(F.count_if("_u").alias("unexplained"), F.count_if("_o").alias("open"))


_WRONG = _COMPONENTS.replace("kv AS (", "ke AS (SELECT * REPLACE (balance + CASE WHEN m = DATE '1997-03-31' AND scope IN ('ASIA', 'GROUP') THEN 1.00 ELSE 0 END AS balance, unrounded + CASE WHEN m = DATE '1997-03-31' AND scope IN ('ASIA', 'GROUP') THEN 1.00 ELSE 0 END AS unrounded) FROM kg),\nkv AS (").replace("FROM kg) WHERE value", "FROM ke) WHERE value")


@query(_bridge_sql(_WRONG) + "SELECT month_end::VARCHAR AS month_end, scope, kpi, cause_id, " + _round_sql("amount") + " FROM att WHERE classification = 'UNEXPLAINED' AND kpi = 'portfolio_balance_eur'")
def injected_error_found(spark, d):
    """A balance that is wrong by one euro in the new model: no fault and no definition accounts for it."""
    a = rec.attribution(bridged(spark, d, 1.0)).where("classification = 'UNEXPLAINED' AND kpi = 'portfolio_balance_eur'")
    return a.select(txt("month_end").alias("month_end"), "scope", "kpi", "cause_id", _round("amount"))


def _profile_sql(source: str = "br", legacy: str = "legacy_published", new: str = "gold_published", by: str = "scope, kpi") -> str:
    ratio = f"{new} / nullif({legacy}, 0)"
    return f""", x AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY month_end) - 1 AS i, {new} - {legacy} AS diff, abs({new} - {legacy}) > tolerance AS off_, CASE WHEN abs({new} - {legacy}) > tolerance THEN {ratio} END AS ratio FROM {source}),
pr AS (SELECT {by}, count(*) FILTER (WHERE off_) AS months_affected, count(*) AS months_in_series, min(month_end) FILTER (WHERE off_)::VARCHAR AS first_affected_month, coalesce(min(i) FILTER (WHERE off_), -1) AS first_affected_index, max(abs(diff)) AS largest_difference, max(tolerance) AS tolerance, coalesce(max(abs(ratio - 1)), 0) AS largest_relative_difference, coalesce(max(ratio) - min(ratio), 0) AS ratio_spread,
  coalesce(count(ratio) > 2 AND (min(ratio) > 1 OR max(ratio) < 1), false) AS ratio_always_same_side, coalesce(bool_or(i = 0 AND abs({legacy}) <= tolerance AND abs({new}) > tolerance), false) AS legacy_zero_in_first_month FROM x GROUP BY {by}),
dg AS (SELECT *, CASE WHEN months_affected = 0 THEN 'nothing to do' ELSE coalesce(nullif(concat_ws('; ', CASE WHEN legacy_zero_in_first_month THEN 'check which month the formula reads' END,
  CASE WHEN months_affected = months_in_series AND ratio_spread <= 0.02 THEN 'look for a rate or factor typed into a formula' WHEN months_affected = months_in_series AND ratio_spread <= 0.10 AND ratio_always_same_side THEN 'compare the factor used with the rate table, month by month' END,
  CASE WHEN NOT legacy_zero_in_first_month AND first_affected_index > 0 THEN 'look at what was delivered or changed in ' || first_affected_month WHEN NOT legacy_zero_in_first_month AND months_affected < months_in_series THEN 'compare the rows of the months that differ' END,
  CASE WHEN largest_relative_difference < 1e-6 THEN 'check where amounts are rounded' END), ''), 'trace one month by hand') END AS diagnosis FROM pr)
"""


@query(_BR + _profile_sql() + "SELECT scope, kpi, months_affected, months_in_series, first_affected_month, first_affected_index, round(largest_difference, 4) AS largest_difference, round(largest_relative_difference, 6) AS largest_relative_difference, round(ratio_spread, 6) AS ratio_spread, ratio_always_same_side, legacy_zero_in_first_month FROM pr")
def difference_profile(spark, d):
    p = rec.difference_profile(bridged(spark, d))
    return p.withColumns({"first_affected_month": txt("first_affected_month"), "largest_difference": F.round("largest_difference", 4), "largest_relative_difference": F.round("largest_relative_difference", 6), "ratio_spread": F.round("ratio_spread", 6)})


@query(_BR + _profile_sql() + "SELECT scope, kpi, diagnosis FROM dg")
def signatures(spark, d):
    return rec.diagnose(rec.difference_profile(bridged(spark, d))).select("scope", "kpi", "diagnosis")


_TRAIL = ", rd AS (SELECT month_end, scope, kpi, tolerance, legacy_def, unnest([{'round': '0', 'legacy': legacy_published}, {'round': '1', 'legacy': s1}, {'round': '2', 'legacy': s2}, {'round': '3', 'legacy': s3}], recursive := true) FROM br)" + _profile_sql("rd", "legacy", "legacy_def", "round, scope, kpi")


@query(_BR + _TRAIL + "SELECT round, scope, kpi, months_affected, first_affected_month, " + _round_sql("largest_difference") + ", diagnosis FROM dg")
def peeling_trail(spark, d):
    t = rec.peeling_trail(bridged(spark, d))
    return t.select("round", "scope", "kpi", "months_affected", txt("first_affected_month").alias("first_affected_month"), _round("largest_difference"), "diagnosis")


@query(_BR + _TRAIL + "SELECT round, kpi, arg_min(scope, (-round(largest_difference / tolerance), scope)) AS scope, round(arg_min(largest_difference, (-round(largest_difference / tolerance), scope)), 4) AS largest_difference, count(DISTINCT scope) AS scopes_differing FROM dg WHERE months_affected > 0 GROUP BY round, kpi")
def trail_highlights(spark, d):
    return rec.trail_highlights(rec.peeling_trail(bridged(spark, d))).select("round", "kpi", "scope", F.round("largest_difference", 4).alias("largest_difference"), "scopes_differing")


@query(_BR + "SELECT month_end::VARCHAR AS month_end, scope, kpi, round(legacy_published, 2) AS legacy_published, round(gold_published, 2) AS gold_published, round(total_difference, 2) AS total_difference FROM br ORDER BY round(abs(br.total_difference), 6) DESC, br.month_end, scope, kpi LIMIT 10")
def worst_cells(spark, d):
    return rec.worst(bridged(spark, d)).select(txt("month_end").alias("month_end"), "scope", "kpi", *[F.round(c, 2).alias(c) for c in ("legacy_published", "gold_published", "total_difference")])


_KNOWN = ", ".join(f"('{c.id}', '{c.classification}', '{c.kind}')" for c in rec.CAUSES[:-1])


@query(_BR + f"SELECT c.cause_id, c.classification, c.kind, coalesce(count(a.cause_id), 0) AS cells_affected, min(a.month_end)::VARCHAR AS first_month, coalesce(round(max(abs(amount)), 4), 0) AS largest, coalesce(round(max(abs(amount) / nullif(abs(legacy_published), 0)), 6), 0) AS relative, coalesce(string_agg(DISTINCT a.kpi, ', ' ORDER BY a.kpi), '') AS kpis, coalesce(string_agg(DISTINCT a.scope, ', ' ORDER BY a.scope), '') AS scopes FROM (VALUES {_KNOWN}) c(cause_id, classification, kind) LEFT JOIN att a ON a.cause_id = c.cause_id GROUP BY ALL")
def findings_summary(spark, d):
    f = rec.findings(bridged(spark, d))
    return f.select("cause_id", "classification", "kind", "cells_affected", txt("first_month").alias("first_month"), F.round("largest_single_difference", 4).alias("largest"), F.round("largest_relative_difference", 6).alias("relative"), "kpis", "scopes")


@query(_BR + "SELECT (SELECT count(*) FROM br) AS compared, (SELECT count(*) FROM br WHERE abs(total_difference) > tolerance) AS differ, (SELECT count(DISTINCT (month_end, scope, kpi)) FROM att WHERE classification = 'LEGACY_ERROR') AS by_error, (SELECT count(DISTINCT cause_id) FROM att WHERE classification = 'LEGACY_ERROR') AS faults, (SELECT count(DISTINCT cause_id) FROM att WHERE classification = 'DEFINITION_CHANGE') AS changes, (SELECT round(min(total_difference), 2) FROM br WHERE kpi = 'portfolio_balance_eur') AS overstatement")
def headline_numbers(spark, d):
    h = rec.headline(bridged(spark, d))
    return h.select(F.col("cells_compared").alias("compared"), F.col("cells_that_differed").alias("differ"), F.col("cells_affected_by_a_legacy_error").alias("by_error"), F.col("legacy_faults_found").alias("faults"), F.col("definition_changes").alias("changes"), F.round("largest_overstatement_eur", 2).alias("overstatement"))


@query(_SHEET + "SELECT m::VARCHAR AS month_end, scope, opened, disbursed::DOUBLE AS disbursed FROM sheet WHERE m BETWEEN DATE '1996-01-31' AND DATE '1997-12-31'")
def reporting_window(spark, d):
    s = within_months(both_sides(spark, d), month_ends("1996-01-31", "1997-12-31"))
    return s.select(txt("month_end").alias("month_end"), "scope", F.col("opened").cast("bigint").alias("opened"), dbl("disbursed").alias("disbursed"))


def model_facts(spark, d):
    """The testdata in the shape of the balance fact."""
    f = facts(spark, d)
    return f.select(F.col("o_custkey").alias("customer_id"), F.col("n_name").alias("country_code"), "r_name", fn.date_key("m").alias("date_key"), (F.col("flag") != "R").alias("is_active"), F.col("eur").alias("balance_eur"), ((F.col("flag") != "R") & (F.col("dpd") >= 30)).alias("is_dpd30"), ((F.col("flag") != "R") & (F.col("dpd") >= 90)).alias("is_dpd90"))


@query(", k AS (SELECT r_name, m, sum(eur) AS b, sum(CASE WHEN dpd >= 30 THEN eur ELSE 0 END) AS l FROM f WHERE flag <> 'R' GROUP BY r_name, m) SELECT r_name, arg_max(l::DOUBLE / b::DOUBLE, m) AS rate FROM k GROUP BY r_name")
def star_relationships(spark, d):
    f = model_facts(spark, d)
    return ms.evaluate("30+ DPD rate", lambda _: f, ["r_name"]).select("r_name", F.col("30+ DPD rate").alias("rate"))


@query(", k AS (SELECT m, sum(eur)::DOUBLE AS b FROM f WHERE flag <> 'R' GROUP BY m) SELECT a.m::VARCHAR AS month_end, (a.b - p.b) / p.b AS change FROM k a LEFT JOIN k p ON p.m = last_day(a.m - INTERVAL 1 MONTH)")
def measure_mom(spark, d):
    f = model_facts(spark, d)
    name = "Portfolio balance MoM %"
    return ms.evaluate(name, lambda _: f, [], months=True).select(txt("month_end").alias("month_end"), F.col(name).alias("change"))


# The testdata as a star: orders are the fact, customers and nations its dimensions.
STAR = [("fact_order", "o_custkey", "dim_customer", "c_custkey"), ("fact_order", "n_nationkey", "dim_nation", "n_nationkey")]
STAR_ROLES = {"one region": ["ASIA"], "group": None}
STAR_SECURED = {"dim_nation": "r_name"}


def star(spark, d):
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    tables = {
        "dim_customer": read(spark, d, "customer"),
        "dim_nation": n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name"),
        "fact_order": orders_by_place(spark, d).select("o_custkey", "n_nationkey", F.col("total").alias("amount_eur")),
    }
    return tables.__getitem__


@query("SELECT c_mktsegment AS segment, n_name, count(*)::DOUBLE AS n FROM o JOIN pl ON o_custkey = c_custkey JOIN customer USING (c_custkey) GROUP BY c_mktsegment, n_name")
def measure_by_attributes(spark, d):
    """A measure of the fact grouped by attributes of two dimensions, joined through the relationships."""
    m = ms.Model(star(spark, d), "group", STAR_ROLES, STAR, STAR_SECURED)
    j = m.joined("fact_order", ["dim_customer.c_mktsegment", "dim_nation.n_name"])
    return j.groupBy(F.col("dim_customer_c_mktsegment").alias("segment"), F.col("dim_nation_n_name").alias("n_name")).agg(dbl(F.count("*")).alias("n"))


@query("SELECT n_name, count(*) AS n, sum(total)::DOUBLE AS total FROM o JOIN pl ON o_custkey = c_custkey WHERE r_name = 'ASIA' GROUP BY n_name")
def rls_country(spark, d):
    m = ms.Model(star(spark, d), "one region", STAR_ROLES, STAR, STAR_SECURED)
    j = m.joined("fact_order", ["dim_nation.n_name"])
    return j.groupBy(F.col("dim_nation_n_name").alias("n_name")).agg(F.count("*").alias("n"), dbl(F.sum("amount_eur")).alias("total"))


_STOCKS = {"Portfolio balance (EUR)": "sum(eur)::DOUBLE", "Active accounts": "count(*)::DOUBLE", "Active customers": "count(DISTINCT o_custkey)::DOUBLE", "Balance 30+ DPD (EUR)": "sum(CASE WHEN dpd >= 30 THEN eur ELSE 0 END)::DOUBLE", "Balance 90+ DPD (EUR)": "sum(CASE WHEN dpd >= 90 THEN eur ELSE 0 END)::DOUBLE"}
_RATIOS = {"30+ DPD rate": ("Balance 30+ DPD (EUR)", "Portfolio balance (EUR)"), "90+ DPD rate": ("Balance 90+ DPD (EUR)", "Portfolio balance (EUR)"), "Avg balance per customer (EUR)": ("Portfolio balance (EUR)", "Active customers"), "Avg balance per account (EUR)": ("Portfolio balance (EUR)", "Active accounts")}


def _balance_measures_sql() -> str:
    each = [f"SELECT r_name, '{n}' AS measure, arg_max(v, m) AS value FROM (SELECT r_name, m, {sql} AS v FROM f WHERE flag <> 'R' GROUP BY r_name, m) GROUP BY r_name" for n, sql in _STOCKS.items()]
    each += [f"SELECT r_name, '{n}', arg_max(a / b, m) FROM (SELECT r_name, m, {_STOCKS[x]} AS a, {_STOCKS[y]} AS b FROM f WHERE flag <> 'R' GROUP BY r_name, m) GROUP BY r_name" for n, (x, y) in _RATIOS.items()]
    return " UNION ALL ".join(each)


def by_measure(read_, names):
    """The measures by region, a row each."""
    wide = ms.evaluate_many(names, read_, ["r_name"])
    return unpivot(wide, ["r_name"], [(n, "", F.col(f"`{n}`")) for n in names], ("measure", "_")).drop("_")


@query(_balance_measures_sql())
def balance_measures(spark, d):
    """All measures of the balance fact that need no month, by region."""
    return by_measure(lambda _: model_facts(spark, d), [*_STOCKS, *_RATIOS])


@query(", k AS (SELECT m, sum(eur)::DOUBLE AS b, sum(CASE WHEN dpd >= 30 THEN eur ELSE 0 END)::DOUBLE AS l FROM f WHERE flag <> 'R' GROUP BY m) SELECT a.m::VARCHAR AS month_end, p.b AS balance_before, a.l / a.b - p.l / p.b AS rate_change FROM k a LEFT JOIN k p ON p.m = last_day(a.m - INTERVAL 1 MONTH)")
def shifted_measures(spark, d):
    f = model_facts(spark, d)
    both = ms.evaluate_many(["30+ DPD rate change", "Portfolio balance last month (EUR)", "Portfolio balance (EUR)"], lambda _: f, [], months=True)
    return both.where("`Portfolio balance (EUR)` IS NOT NULL").select(txt("month_end").alias("month_end"), F.col("Portfolio balance last month (EUR)").alias("balance_before"), F.col("30+ DPD rate change").alias("rate_change"))


def flow_tables(spark, d):
    """Orders as accounts opened, as applications and as repayments; checks and causes from orders as well."""
    o = orders_by_place(spark, d)
    amount = fn.to_eur("total", "rate_avg").alias("amount_eur")
    return {
        "fact_origination": o.select("r_name", amount), "fact_repayment": o.select("r_name", amount),
        "fact_application": o.select("r_name", F.col("st").isin("F", "O").alias("is_decisioned"), (F.col("st") == "F").alias("is_approved")),
        "dq_results": o.select("r_name", (F.col("st") != "P").alias("passed")),
        "recon_attribution": o.select("r_name", F.when(F.col("st") == "P", "UNEXPLAINED").otherwise("LEGACY_ERROR").alias("classification"), F.lit("portfolio_balance_eur").alias("kpi"), F.col("total").alias("amount")),
    }.__getitem__


_FLOWS = {
    "New accounts": "count(*)::DOUBLE", "New originations (EUR)": "sum(e)::DOUBLE", "Avg loan size (EUR)": "sum(e)::DOUBLE / count(*)::DOUBLE", "Applications received": "count(*)::DOUBLE", "Applications decisioned": "(count(*) FILTER (WHERE st IN ('F', 'O')))::DOUBLE", "Applications approved": "(count(*) FILTER (WHERE st = 'F'))::DOUBLE",
    "Approval rate": "(count(*) FILTER (WHERE st = 'F'))::DOUBLE / (count(*) FILTER (WHERE st IN ('F', 'O')))::DOUBLE", "Approval rate (legacy definition)": "(count(*) FILTER (WHERE st = 'F'))::DOUBLE / count(*)::DOUBLE", "Repayments (EUR)": "sum(e)::DOUBLE",
    "Quality checks run": "count(*)::DOUBLE", "Quality checks failed": "(count(*) FILTER (WHERE st = 'P'))::DOUBLE", "Legacy error effect (EUR)": "(sum(total) FILTER (WHERE st <> 'P'))::DOUBLE", "Unexplained differences": "(count(*) FILTER (WHERE st = 'P'))::DOUBLE",
}


@query(_COMPONENTS + ", fl AS (SELECT *, round(total * ra, 2)::DECIMAL(18,2) AS e FROM orr) " + " UNION ALL ".join(f"SELECT r_name, '{n}' AS measure, {sql} AS value FROM fl GROUP BY r_name" for n, sql in _FLOWS.items()))
def flow_measures(spark, d):
    """All measures of flows, of checks and of the reconciliation, by region."""
    return by_measure(flow_tables(spark, d), list(_FLOWS))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type", pre=False)
def stream_bronze_available_now(spark, d):
    from ..streaming import land

    return land(spark, f"{d}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))
