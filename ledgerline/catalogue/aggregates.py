"""Joins, aggregations, windows, pivots over the portfolio facts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import kpis
from ..operators import legacy as leg
from ..operators import relational as rel
from ..plans import checks
from .base import dbl, facts, judged, lines, orders, places, query, rate, rates, read, txt

# A month's balance and late share for every nation and the group; the same sums that the KPI table is made of.
_FLAG = """, k AS (SELECT m, n_name AS scope, sum(eur) AS balance, sum(CASE WHEN dpd >= 30 THEN eur ELSE 0 END) AS late30, sum(CASE WHEN dpd >= 90 THEN eur ELSE 0 END) AS late90, sum(price * rate_end) AS unrounded, count(*) AS accounts, count(DISTINCT o_custkey) AS customers FROM f WHERE flag <> 'R' GROUP BY m, n_name),
g AS (SELECT * FROM k UNION ALL SELECT m, 'GROUP', sum(balance), sum(late30), sum(late90), sum(unrounded), sum(accounts), sum(customers) FROM k GROUP BY m)
"""


def orders_by_place(spark, d):
    """Orders with their nation and region and the rates of their month."""
    o = orders(spark, d).join(places(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    return o.withColumns({"rate_end": rate("m", "r_regionkey"), "rate_avg": rate("m", "r_regionkey", 5)})


def balance_facts(spark, d, scope="n_name"):
    f = facts(spark, d)
    return f.select(F.col("m").alias("month_end"), F.col(scope).alias("scope"), F.col("o_custkey").alias("customer"), F.col("price").alias("balance_local"), F.col("eur").alias("balance_eur"), F.col("rate_end").alias("rate"), "dpd", (F.col("flag") != "R").alias("active"))


def group_components(spark, d):
    return rel.with_total(kpis.balance_components(balance_facts(spark, d)), "month_end", "scope")


@query(_FLAG + "SELECT m::VARCHAR AS month_end, scope, balance::DOUBLE AS balance, accounts::BIGINT AS accounts, customers::BIGINT AS customers, late30::DOUBLE / balance::DOUBLE AS dpd30_rate FROM g")
def kpi_flagship(spark, d):
    g = group_components(spark, d)
    return g.select(txt("month_end").alias("month_end"), "scope", dbl("balance").alias("balance"), F.col("accounts").cast("bigint").alias("accounts"), F.col("customers").cast("bigint").alias("customers"), fn.ratio("late30", "balance").alias("dpd30_rate"))


@query(_FLAG + "SELECT m::VARCHAR AS month_end, scope, (balance - unrounded)::DECIMAL(28,8)::DOUBLE AS rounding FROM g")
def eur_rowround_vs_total(spark, d):
    return group_components(spark, d).select(txt("month_end").alias("month_end"), "scope", dbl(F.col("balance").cast("decimal(28,8)") - F.col("unrounded").cast("decimal(28,8)")).alias("rounding"))


@query("SELECT bucket, bucket_order::INTEGER AS bucket_order, r_name, sum(eur)::DOUBLE AS eur, count(*) AS n FROM f GROUP BY ALL ORDER BY bucket_order")
def dpd_bucket_matrix(spark, d):
    return facts(spark, d).groupBy("bucket", "bucket_order", "r_name").agg(dbl(F.sum("eur")).alias("eur"), F.count("*").alias("n")).orderBy("bucket_order")


@query("SELECT n_name, p_brand, sum(price)::DOUBLE AS amount FROM li JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, p_brand ORDER BY n_name, p_brand")
def star_join_agg(spark, d):
    s, n, p = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "part").select("p_partkey", "p_brand")
    place = s.join(rel.measured(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    j = lines(spark, d).join(p, F.col("l_partkey") == F.col("p_partkey")).join(place, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy("n_name", "p_brand").agg(dbl(F.sum("price")).alias("amount")).orderBy("n_name", "p_brand")


@query("""SELECT coalesce(a.m, b.m)::VARCHAR AS month_end, coalesce(n, 0) AS orders, coalesce(e, 0) AS events FROM (SELECT m, count(*) AS n FROM o GROUP BY m) a FULL JOIN (SELECT last_day(ts::DATE) AS m, count(*) AS e FROM events GROUP BY 1) b ON a.m = b.m""")
def full_outer_components(spark, d):
    a = orders(spark, d).groupBy("m").agg(F.count("*").alias("orders"))
    b = read(spark, d, "events").groupBy(F.last_day(F.col("ts").cast("date")).alias("m")).agg(F.count("*").alias("events"))
    return rel.outer_zero(a, b, ["m"]).select(txt("m").alias("month_end"), "orders", "events")


@query("""SELECT n_name AS scope, m::VARCHAR AS month_end, sum(total)::DOUBLE AS total FROM o JOIN pl ON o_custkey = c_custkey GROUP BY ALL UNION ALL SELECT 'GROUP', m::VARCHAR, sum(total)::DOUBLE FROM o GROUP BY m""")
def group_scope_total(spark, d):
    k = orders(spark, d).join(places(spark, d), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("m").alias("month_end"), F.col("n_name").alias("scope")).agg(F.sum("total").alias("total"))
    return rel.with_total(k, "month_end", "scope").select("scope", txt("month_end").alias("month_end"), dbl("total").alias("total"))


_UNPIVOT = "SELECT m::VARCHAR AS month_end, 'total' AS kpi, 'sum' AS variant, sum(total)::DOUBLE AS value FROM o GROUP BY m UNION ALL SELECT m::VARCHAR, 'total', 'max', max(total)::DOUBLE FROM o GROUP BY m UNION ALL SELECT m::VARCHAR, 'share_f', 'new', (count(*) FILTER (WHERE st = 'F'))::DOUBLE / count(*)::DOUBLE FROM o GROUP BY m"


def variants(spark, d):
    k = orders(spark, d).groupBy(txt("m").alias("month_end")).agg(F.sum("total").alias("s"), F.max("total").alias("x"), F.count_if(F.expr("st = 'F'")).alias("f"), F.count("*").alias("n"))
    return rel.unpivot(k, ["month_end"], [("total", "sum", F.col("s")), ("total", "max", F.col("x")), ("share_f", "new", fn.ratio("f", "n"))])


@query(_UNPIVOT)
def unpivot_variants(spark, d):
    return variants(spark, d)


@query(", u AS (" + _UNPIVOT + ") SELECT month_end, kpi, avg(value) FILTER (WHERE variant = 'sum') AS sum, avg(value) FILTER (WHERE variant = 'max') AS max, avg(value) FILTER (WHERE variant = 'new') AS new FROM u GROUP BY month_end, kpi")
def pivot_variants_wide(spark, d):
    return variants(spark, d).groupBy("month_end", "kpi").pivot("variant", ["sum", "max", "new"]).agg(F.avg("value"))


@query("SELECT l_suppkey, CASE WHEN sum(CASE WHEN flag = 'R' AND l_suppkey % 2 = 0 THEN qty ELSE 0 END) = 0 THEN NULL ELSE sum(price)::DOUBLE / sum(CASE WHEN flag = 'R' AND l_suppkey % 2 = 0 THEN qty ELSE 0 END)::DOUBLE END AS ratio FROM li GROUP BY l_suppkey")
def ratio_safe_divide(spark, d):
    qty = F.sum(F.when((F.col("flag") == "R") & (F.col("l_suppkey") % 2 == 0), F.col("qty")).otherwise(F.lit(0)))
    return lines(spark, d).groupBy("l_suppkey").agg(fn.ratio(F.sum("price"), qty).alias("ratio"))


@query("SELECT l_suppkey, CASE WHEN l_suppkey % 2 = 1 THEN 0 ELSE sum(price)::DOUBLE / sum(qty)::DOUBLE END AS ratio FROM li GROUP BY l_suppkey")
def iferror_zero(spark, d):
    qty = fn.sum_if("qty", F.col("l_suppkey") % 2 == 0)
    return lines(spark, d).groupBy("l_suppkey").agg(fn.ratio_or_zero(F.sum("price"), qty).alias("ratio"))


@query("SELECT m::VARCHAR AS month_end, count(DISTINCT o_custkey) AS customers FROM o GROUP BY m")
def distinct_customers(spark, d):
    return orders(spark, d).groupBy(txt("m").alias("month_end")).agg(F.countDistinct("o_custkey").alias("customers"))


@query("SELECT o_orderkey, total::DOUBLE AS total FROM o WHERE odate = (SELECT max(odate) FROM o)")
def scalar_subquery_latest(spark, d):
    o = orders(spark, d)
    newest = o.agg(F.max("odate").alias("newest"))
    return o.join(F.broadcast(newest), F.col("odate") == F.col("newest")).select("o_orderkey", dbl("total").alias("total"))


_PAID = "SELECT o_orderkey, coalesce((SELECT sum(price) FROM li WHERE l_orderkey = o_orderkey AND ship <= odate), 0)::DOUBLE AS paid FROM o"


@query(_PAID)
def correlated_paid_to_date(spark, d):
    o = orders(spark, d).select("o_orderkey", "odate")
    j = o.join(lines(spark, d), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("ship") <= F.col("odate")), "left")
    return j.groupBy("o_orderkey").agg(dbl(F.coalesce(F.sum("price"), F.lit(0))).alias("paid"))


@query("SELECT o_custkey, o_orderkey, sum(total) OVER (PARTITION BY o_custkey ORDER BY odate RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS running FROM o")
def running_total(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("odate").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return orders(spark, d).select("o_custkey", "o_orderkey", dbl(F.sum("total").over(w)).alias("running"))


@query("SELECT flag, status, year(ship)::INTEGER AS y, count(*) AS n, (sum(qty)::DOUBLE / count(*)) AS mean FROM li GROUP BY ALL")
def avg_count_by_three(spark, d):
    return lines(spark, d).groupBy("flag", "status", F.year("ship").alias("y")).agg(F.count("*").alias("n"), (dbl(F.sum("qty")) / F.count("*")).alias("mean"))


@query("SELECT m::VARCHAR AS month_end, n_name, bucket, count(*) AS accounts, sum(price)::DOUBLE AS balance FROM f GROUP BY ALL")
def cube_extract(spark, d):
    return facts(spark, d).groupBy(txt("m").alias("month_end"), "n_name", "bucket").agg(F.count("*").alias("accounts"), dbl(F.sum("price")).alias("balance"))


@query("SELECT m::VARCHAR AS month_end, st, count(*) AS accounts, sum(total)::DOUBLE AS amount FROM o GROUP BY ALL")
def orig_extract(spark, d):
    return orders(spark, d).groupBy(txt("m").alias("month_end"), "st").agg(F.count("*").alias("accounts"), dbl(F.sum("total")).alias("amount"))


@query("SELECT m::VARCHAR AS month_end, count(*) FILTER (WHERE st = 'F') AS F, count(*) FILTER (WHERE st = 'O') AS O, count(*) FILTER (WHERE st = 'P') AS P, count(*) AS total FROM o GROUP BY m")
def pivot_status(spark, d):
    return rel.pivot_count(orders(spark, d).withColumn("month_end", txt("m")), ["month_end"], "st", ["F", "O", "P"])


@query("SELECT m::VARCHAR AS month_end, " + ", ".join(f"max(CASE WHEN r_regionkey = {k} THEN e END)::DOUBLE AS r{k}" for k in range(5)) + " FROM (SELECT DISTINCT m, r_regionkey, ((200000 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6) AS e FROM o, region) GROUP BY m")
def pivot_rates(spark, d):
    wide = leg.wide_rates(rates(spark, d), [str(k) for k in range(5)])
    return wide.select(txt("month_end").alias("month_end"), *[dbl(str(k)).alias(f"r{k}") for k in range(5)])


@query("SELECT q AS quarter, bal::DOUBLE AS balance FROM (SELECT year(m) || '-' || quarter(m) AS q, m, sum(total) AS bal, row_number() OVER (PARTITION BY year(m) || '-' || quarter(m) ORDER BY m DESC) AS k FROM o GROUP BY m) WHERE k = 1")
def semi_additive_balance(spark, d):
    by_month = orders(spark, d).groupBy("m").agg(F.sum("total").alias("b"))
    return by_month.groupBy(F.concat(F.year("m"), F.lit("-"), F.quarter("m")).alias("quarter")).agg(dbl(F.max_by("b", "m")).alias("balance"))


@query("SELECT a.m::VARCHAR AS month_end, a.s::DOUBLE AS now, b.s::DOUBLE AS before, (a.s::DOUBLE - b.s::DOUBLE) / b.s::DOUBLE AS growth FROM (SELECT m, sum(total) AS s FROM o GROUP BY m) a LEFT JOIN (SELECT m, sum(total) AS s FROM o GROUP BY m) b ON b.m = last_day(a.m - INTERVAL 1 MONTH)")
def mom_growth(spark, d):
    now = orders(spark, d).groupBy(F.col("m").alias("month_end")).agg(dbl(F.sum("total")).alias("now"))
    j = rel.previous_month(now, "month_end", [], "now", "before")
    return j.select(txt("month_end").alias("month_end"), "now", "before", F.try_divide(F.col("now") - F.col("before"), "before").alias("growth"))


@query("SELECT m::VARCHAR AS month_end, sum(s) OVER (ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)::DOUBLE AS last12 FROM (SELECT m, sum(total) AS s FROM o GROUP BY m)")
def trailing_12_months(spark, d):
    by_month = orders(spark, d).groupBy(F.col("m").alias("month_end")).agg(F.sum("total").alias("s"))
    return leg.trailing(by_month, "month_end", "s", "last12").select(txt("month_end").alias("month_end"), dbl("last12").alias("last12"))


@query(", k AS (SELECT m, n_name, sum(CASE WHEN dpd >= 30 THEN price ELSE 0 END) AS late FROM f GROUP BY m, n_name) SELECT a.m::VARCHAR AS month_end, a.n_name, coalesce(b.late, 0)::DOUBLE AS before FROM k a LEFT JOIN k b ON b.n_name = a.n_name AND b.m = last_day(a.m - INTERVAL 1 MONTH)")
def prior_month_numerator(spark, d):
    k = facts(spark, d).groupBy(F.col("m").alias("month_end"), "n_name").agg(fn.sum_if("price", F.col("dpd") >= 30).alias("late"))
    return rel.previous_month(k, "month_end", ["n_name"], "late", "before").select(txt("month_end").alias("month_end"), "n_name", dbl(F.coalesce("before", F.lit(0))).alias("before"))


@query("SELECT last_day(day)::VARCHAR AS month_end, event_type, count(*) AS n, round(avg(v), 9) AS mean, arg_max(v, day) AS last FROM (SELECT ts::DATE AS day, event_type, count(*)::DOUBLE AS v FROM events GROUP BY 1, 2) GROUP BY 1, 2", pre=False)
def month_mean_and_last(spark, d):
    daily = read(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(dbl(F.count("*")).alias("v"))
    return leg.monthly_path(daily, ["event_type"], "day", "v").select(txt("month_end").alias("month_end"), "event_type", "n", F.round("mean", 9).alias("mean"), "last")


@query("SELECT event_type, max(ts)::DATE::VARCHAR AS newest, arg_max(event_id, ts) AS event_id FROM events GROUP BY event_type", pre=False)
def latest_batch_max_by(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(txt(F.max("ts").cast("date")).alias("newest"), F.max_by("event_id", "ts").alias("event_id"))


@query("SELECT o_orderkey, o_custkey, sum(eur)::DOUBLE AS late FROM f WHERE dpd >= 90 GROUP BY o_orderkey, o_custkey ORDER BY sum(eur) DESC, o_orderkey LIMIT 50")
def topk_worst_accounts(spark, d):
    late = facts(spark, d).where("dpd >= 90").groupBy("o_orderkey", "o_custkey").agg(F.sum("eur").alias("s"))
    return late.orderBy(F.col("s").desc(), "o_orderkey").limit(50).select("o_orderkey", "o_custkey", dbl("s").alias("late"))


@query("SELECT 1::BIGINT AS rows_checked, (max(abs(g - s)) > 0.05)::BIGINT AS rows_failed FROM (SELECT m, sum(total)::DOUBLE AS g FROM o GROUP BY m) JOIN (SELECT m, sum(total)::DOUBLE AS s FROM o WHERE st <> 'P' GROUP BY m) USING (m)")
def group_vs_sum_gap(spark, d):
    """The check over a KPI table whose group figure holds orders that no scope has."""
    o = orders(spark, d).groupBy(F.col("m").alias("month_end"), F.col("st").alias("scope")).agg(dbl(F.sum("total")).alias("value"))
    group = orders(spark, d).groupBy(F.col("m").alias("month_end")).agg(F.lit("GROUP").alias("scope"), dbl(F.sum("total")).alias("value"))
    table = o.where("scope <> 'P'").unionByName(group).withColumns({"kpi": F.lit("portfolio_balance_eur"), "variant": F.lit("legacy_def")})
    return judged(spark, [checks.group_equals_sum("portfolio_balance_eur")], {checks.KPI: table}).select("rows_checked", "rows_failed")


@query("SELECT CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side, count(*) AS n FROM (SELECT o_orderkey AS k FROM o WHERE st <> 'P') a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM li WHERE flag = 'R') b ON a.k = b.k GROUP BY 1")
def full_outer_indicator(spark, d):
    a = orders(spark, d).where("st <> 'P'").select(F.col("o_orderkey").alias("a"))
    b = lines(spark, d).where("flag = 'R'").select(F.col("l_orderkey").alias("b")).distinct()
    side = F.when(F.col("b").isNull(), "left").when(F.col("a").isNull(), "right").otherwise("both")
    return a.join(b, F.col("a") == F.col("b"), "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@query("SELECT bucket, CASE bucket WHEN 'Current' THEN 0 WHEN '1-29' THEN 1 WHEN '30-59' THEN 30 WHEN '60-89' THEN 60 ELSE 90 END AS dpd_min, count(*) AS n FROM f GROUP BY bucket")
def bucket_min_join(spark, d):
    dim = spark.createDataFrame([(b, low) for b, low, _ in fn.DPD_BUCKETS], "bucket string, dpd_min int")
    return facts(spark, d).groupBy("bucket").count().join(rel.measured(dim), "bucket").select("bucket", "dpd_min", F.col("count").alias("n"))


@query("SELECT m::VARCHAR AS month_end, r_name, sum(price * rate_avg)::DECIMAL(28,8)::DOUBLE AS at_avg, sum(price * rate_end)::DECIMAL(28,8)::DOUBLE AS at_end FROM f GROUP BY m, r_name")
def fx_rejoin_components(spark, d):
    f = facts(spark, d).drop("rate_end", "rate_avg").withColumn("currency", txt("r_regionkey"))
    j = rel.rate_on(f, rates(spark, d), F.col("m"))
    s = lambda c: dbl(F.sum(F.col("price") * F.col(c)).cast("decimal(28,8)"))
    return j.groupBy(txt("m").alias("month_end"), "r_name").agg(s("rate_avg").alias("at_avg"), s("rate_end").alias("at_end"))


@query("SELECT m::VARCHAR AS month_end, sum(price)::DOUBLE AS balance FROM f GROUP BY m")
def balance_by_month(spark, d):
    return facts(spark, d).groupBy(txt("m").alias("month_end")).agg(dbl(F.sum("price")).alias("balance"))
