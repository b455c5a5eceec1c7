"""Checks as queries: each kind by itself, and many in one scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import functions as fn
from .. import ops
from ..operators import quality as q
from ..operators import relational as rel
from ..plans import checks
from .aggregates import orders_by_place
from .base import dbl, facts, judged, lines, orders, query, read, txt


def _one(df, check):
    return q.scorecard(df, [check]).select("n", F.col("failed_0").alias("failed"))


@query("SELECT sum(c)::BIGINT AS n, count(*) FILTER (WHERE c > 1) AS keys, sum(c - 1)::BIGINT AS extra FROM (SELECT count(*) AS c FROM li GROUP BY l_orderkey, l_linenumber)")
def dq_unique(spark, d):
    return q.duplicates(lines(spark, d), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS n, count(*) FILTER (WHERE nullif(st, 'P') IS NULL OR nullif(o_custkey % 4, 0) IS NULL) AS failed FROM o")
def dq_not_null(spark, d):
    o = orders(spark, d).select(F.nullif("st", F.lit("P")).alias("a"), F.nullif(F.col("o_custkey") % 4, F.lit(0)).alias("b"))
    return _one(o, q.not_null("orders", ["a", "b"]))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE nullif(st, 'P') NOT IN ('F') OR nullif(st, 'P') IS NULL) AS failed FROM o")
def dq_accepted_values(spark, d):
    return _one(orders(spark, d).select(F.nullif("st", F.lit("P")).alias("st")), q.accepted_values("orders", "st", ["F"]))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE v < 3 OR v > 40 OR v IS NULL) AS strict, count(*) FILTER (WHERE v < 3 OR v > 40) AS lenient FROM (SELECT nullif(qty, 7) AS v FROM li)")
def dq_range(spark, d):
    v = lines(spark, d).select(F.nullif("qty", F.lit(7).cast("decimal(12,2)")).alias("v"))
    return q.scorecard(v, [q.value_range("l", "v", 3, 40), q.value_range("l", "v", 3, 40, allow_null=True)]).select("n", F.col("failed_0").alias("strict"), F.col("failed_1").alias("lenient"))


_FK = "SELECT (SELECT count(l_orderkey) FROM li)::BIGINT AS keys_order, (SELECT count(*) FROM li WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o WHERE st = 'F'))::BIGINT AS lost_order, (SELECT count(*) FROM li WHERE flag <> 'A')::BIGINT AS keys_part, (SELECT count(*) FROM li WHERE flag <> 'A' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10))::BIGINT AS lost_part"


@query(_FK)
def dq_referential(spark, d):
    """Two foreign keys of one table in one pass; null keys do not count."""
    child = lines(spark, d).select("l_orderkey", F.when(F.col("flag") != "A", F.col("l_partkey")).alias("l_partkey"))
    tables = {"lines": child, "orders": orders(spark, d).where("st = 'F'"), "parts": read(spark, d, "part").where("p_size > 10")}
    wide = judged(spark, [q.referential("lines", "l_orderkey", "orders", "o_orderkey"), q.referential("lines", "l_partkey", "parts", "p_partkey")], tables)
    pick = lambda name, column: F.max(F.when(F.col("check_name").endswith(name), F.col(column)))
    return wide.agg(pick("ref_orders", "rows_checked").alias("keys_order"), pick("ref_orders", "rows_failed").alias("lost_order"), pick("ref_parts", "rows_checked").alias("keys_part"), pick("ref_parts", "rows_failed").alias("lost_part"))


@query("SELECT count(*) AS n FROM (SELECT l_orderkey AS k FROM li WHERE flag <> 'A') WHERE k NOT IN (SELECT o_orderkey FROM o WHERE st = 'F')")
def orphan_rows(spark, d):
    child = lines(spark, d).select(F.when(F.col("flag") != "A", F.col("l_orderkey")).alias("k"))
    return q.orphans(child, "k", orders(spark, d).where("st = 'F'"), "o_orderkey").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce(nullif(st, 'P') = 'F', false)) AS failed FROM o")
def dq_expression(spark, d):
    return _one(orders(spark, d), q.expression("orders", "finished", "nullif(st, 'P') = 'F'"))


@query("SELECT (SELECT count(*) FROM li) AS rows_checked, ((SELECT count(*) FROM li) - (SELECT count(*) FROM li WHERE flag <> 'R')) AS rows_failed")
def dq_row_count_match(spark, d):
    tables = {"lines": lines(spark, d), "kept": lines(spark, d).where("flag <> 'R'")}
    return judged(spark, [q.row_count_match("lines", "kept")], tables).select("rows_checked", "rows_failed")


@query("SELECT count(*) AS rows_checked, (abs(sum(price) - sum(CASE WHEN flag <> 'X' THEN price ELSE 0 END)) > 0.01)::BIGINT AS same, (abs(sum(price) - sum(CASE WHEN flag <> 'R' THEN price ELSE 0 END)) > 0.01)::BIGINT AS other, (abs(sum(price) - coalesce(sum(price) FILTER (WHERE flag = 'X'), 0)) > 0.01)::BIGINT AS against_nothing FROM li")
def dq_sum_match(spark, d):
    li = lines(spark, d)
    tables = {"lines": li, "same": li.where("flag <> 'X'"), "other": li.where("flag <> 'R'"), "nothing": li.where("flag = 'X'")}
    got = judged(spark, [q.sum_match("lines", "price", t) for t in ("same", "other", "nothing")], tables)
    failed = lambda t: F.max(F.when(F.col("check_name").endswith(f"_{t}"), F.col("rows_failed")))
    return got.agg(F.max("rows_checked").alias("rows_checked"), failed("same").alias("same"), failed("other").alias("other"), failed("nothing").alias("against_nothing"))


@query("SELECT entity, 1::BIGINT AS rows_checked, (coalesce(max(bad::DOUBLE / n::DOUBLE) FILTER (WHERE day = newest), 0) > 0.2)::BIGINT AS rows_failed, bool_or(day = newest) AS loaded FROM (SELECT *, max(day) OVER () AS newest FROM (SELECT event_type AS entity, ts::DATE AS day, count(*) AS n, count(*) FILTER (WHERE value > 80) AS bad FROM events GROUP BY 1, 2)) GROUP BY entity", pre=False)
def dq_quarantine_rate(spark, d):
    """A day of events is a load, an event of a large value a refused row; kinds of events are the entities, of which a day may lack some."""
    loads = read(spark, d, "events").groupBy(F.col("event_type").alias("entity"), F.col("ts").cast("date").alias("loaded_at")).agg(F.count("*").alias("bronze_rows"), F.count_if(F.expr("value > 80")).alias("quarantined_rows"))
    kinds = [r[0] for r in loads.select("entity").distinct().collect()]  # a handful
    got = judged(spark, [checks.quarantine_rate(e, 0.2) for e in kinds], {"silver_load_audit": loads})
    return got.select(F.replace(F.element_at(F.split("check_name", "[.]"), -1), F.lit("quarantine_rate_"), F.lit("")).alias("entity"), "rows_checked", "rows_failed", (~F.col("detail").contains("no load recorded")).alias("loaded"))


_MONTHS = ("1995-01-31", "2001-12-31")


@query("SELECT (84 * 5 - count(*))::BIGINT AS missing FROM (SELECT DISTINCT m, r_regionkey FROM o JOIN pl ON o_custkey = c_custkey WHERE st = 'P' AND m BETWEEN DATE '1995-01-31' AND DATE '2001-12-31')")
def dq_fx_coverage(spark, d):
    """A region's rate of a month is known where it has an open order; the check counts what is missing from the window."""
    known = orders_by_place(spark, d).where("st = 'P'").select(F.col("m").alias("month_end"), F.col("r_regionkey").cast("string").alias("currency"))
    got = judged(spark, [checks.fx_coverage("ERROR", _MONTHS, [str(k) for k in range(5)])], {"silver_fx_rates": known})
    return got.select((F.lit(420) - F.regexp_extract("detail", "^([0-9]+) of", 1).cast("bigint")).alias("missing"))


@query("SELECT ccy, min(m)::VARCHAR AS from_month, max(m)::VARCHAR AS to_month, count(*) AS months FROM (SELECT ccy, m, n - row_number() OVER (PARTITION BY ccy ORDER BY m) AS run FROM (SELECT r_regionkey::VARCHAR AS ccy, last_day((DATE '1995-01-01' + to_months(k::INTEGER))::DATE) AS m, k AS n FROM region, range(84) x(k)) g WHERE NOT EXISTS (SELECT 1 FROM o JOIN pl p ON o_custkey = c_custkey WHERE st = 'P' AND o.m = g.m AND p.r_regionkey::VARCHAR = g.ccy)) GROUP BY ccy, run")
def fx_gaps(spark, d):
    """The months of the window in which a region has no open order, as gaps."""
    known = orders_by_place(spark, d).where("st = 'P'").select(F.col("m").alias("month_end"), F.col("r_regionkey").cast("string").alias("ccy"))
    found = rel.gaps(known, read(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("ccy")), *_MONTHS)
    return found.select("ccy", txt("from_month").alias("from_month"), txt("to_month").alias("to_month"), "months")


_RATES = "SELECT m, (count(*) FILTER (WHERE st = 'F'))::DOUBLE / count(*)::DOUBLE AS r FROM o GROUP BY m"


@query(f"SELECT 1::BIGINT AS rows_checked, (avg(CASE WHEN r = round(r, 6) THEN 1.0 ELSE 0.0 END) > 0.5)::BIGINT AS whole, (avg(CASE WHEN floor(r * 1e6) / 1e6 = round(floor(r * 1e6) / 1e6, 6) THEN 1.0 ELSE 0.0 END) FILTER (WHERE floor(r * 1e6) <> 0) > 0.5)::BIGINT AS cut FROM ({_RATES}) WHERE r <> 0")
def dq_truncated_rates(spark, d):
    """The check passes rates as divided, and fails the same rates cut at six digits."""
    r = orders(spark, d).groupBy("m").agg(fn.ratio(F.count_if(F.expr("st = 'F'")), F.count("*")).alias("value")).withColumn("kpi", F.lit("approval_rate"))
    one = lambda df: judged(spark, [checks.rates_not_truncated()], {checks.KPI: df}).select("rows_checked", F.col("rows_failed"))
    whole, cut = one(r), one(r.withColumn("value", F.floor(F.col("value") * 1e6) / 1e6))
    return whole.withColumnRenamed("rows_failed", "whole").crossJoin(cut.select(F.col("rows_failed").alias("cut")))  # one row each


@query(", k AS (SELECT m, count(*) AS n, count(*) FILTER (WHERE st <> 'P') AS closed, sum(total) AS total, sum(total) FILTER (WHERE st <> 'P') AS total_closed FROM o JOIN pl ON o_custkey = c_custkey GROUP BY m) SELECT 1::BIGINT AS rows_checked, (max(abs(n - n)) > 0.05)::BIGINT AS whole, (max(abs(closed - n)) > 0.05)::BIGINT AS short, max(n - closed)::DOUBLE AS gap FROM k")
def dq_group_equals_sum(spark, d):
    """Accounts opened by region and for the group: as added up, and with a group that leaves open orders out; the gap is named."""
    o = orders_by_place(spark, d).withColumn("month_end", F.col("m"))
    row = lambda scope, value: F.struct(scope.alias("scope"), F.lit("new_accounts").alias("kpi"), F.lit("legacy_def").alias("variant"), value.cast("double").alias("value"))
    by_region = o.groupBy("month_end", "r_name").agg(F.count("*").alias("n")).select("month_end", row(F.col("r_name"), F.col("n")).alias("x")).select("month_end", "x.*")
    group = lambda rows: rows.groupBy("month_end").agg(F.count("*").alias("n")).select("month_end", row(F.lit("GROUP"), F.col("n")).alias("x")).select("month_end", "x.*")
    one = lambda rows: judged(spark, [checks.group_equals_sum("new_accounts")], {checks.KPI: by_region.unionByName(group(rows))})
    short = one(o.where("st <> 'P'")).select(F.col("rows_failed").alias("short"), F.regexp_extract("detail", "gap ([0-9.]+)", 1).cast("double").alias("gap"))
    return one(o).select("rows_checked", F.col("rows_failed").alias("whole")).crossJoin(short)  # one row each


@query("SELECT 'lines.at_' || l AS check_name, 1::BIGINT AS rows_checked, (n > l)::BIGINT AS rows_failed FROM (SELECT count(DISTINCT r_name) AS n FROM li JOIN o ON l_orderkey = o_orderkey JOIN pl ON o_custkey = c_custkey WHERE flag = 'R'), (VALUES (0), (3), (4), (5), (6), (100)) x(l)")
def dq_metric_at_most(spark, d):
    """Regions with returned lines, against limits below, at and above what there is; the limit itself passes."""
    tables = {"lines": facts(spark, d).where("flag = 'R'")}
    metric = lambda read_: (read_("lines").agg(F.countDistinct("r_name")).first()[0], "")
    got = judged(spark, [q.metric_at_most("lines", f"at_{limit}", metric, limit) for limit in (0, 3, 4, 5, 6, 100)], tables)
    return got.select("check_name", "rows_checked", "rows_failed")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber FROM li GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) ORDER BY l_orderkey::VARCHAR, l_linenumber::VARCHAR LIMIT 3")
def dq_failing_sample(spark, d):
    """The rows that a failed check names."""
    detail = judged(spark, [q.unique("lines", ["l_orderkey", "l_linenumber"])], {"lines": lines(spark, d)}).select(F.explode(F.expr("slice(split(detail, '; '), 2, 3)")).alias("x"))
    return detail.select(F.regexp_extract("x", "l_orderkey=([0-9]+)", 1).cast("bigint").alias("l_orderkey"), F.regexp_extract("x", "l_linenumber=([0-9]+)", 1).cast("int").alias("l_linenumber"))


CARD = [q.not_null("l", ["ship"]), q.accepted_values("l", "flag", ["A", "N"]), q.value_range("l", "price", 1000, 90000), q.value_range("l", "qty", 1, 50), q.expression("l", "discounted", "discount > 0 AND price * discount > 50"), q.expression("l", "day", "ship = last_day(ship)", severity="WARN")]


@query("SELECT count(*) AS n, count(*) FILTER (WHERE ship IS NULL) AS failed_0, count(*) FILTER (WHERE flag NOT IN ('A', 'N')) AS failed_1, count(*) FILTER (WHERE price < 1000 OR price > 90000) AS failed_2, count(*) FILTER (WHERE qty < 1 OR qty > 50) AS failed_3, count(*) FILTER (WHERE NOT (discount > 0 AND price * discount > 50)) AS failed_4, count(*) FILTER (WHERE ship <> last_day(ship)) AS failed_5 FROM li")
def dq_fused_scorecard(spark, d):
    return q.scorecard(lines(spark, d), CARD)


@query("SELECT avg(CASE WHEN discount = round(discount, 1) THEN 1.0 ELSE 0.0 END) AS share FROM li")
def exact_share(spark, d):
    return lines(spark, d).agg((dbl(F.count_if(F.col("discount") == F.round("discount", 1))) / F.count("*")).alias("share"))


@query("SELECT entity, reasons, count(*) AS n, min(l_orderkey) AS example FROM (SELECT 'lines' AS entity, l_orderkey, array_to_string(list_filter([CASE WHEN qty < 5 THEN 'SMALL' END, CASE WHEN flag = 'R' THEN 'RETURNED' END], lambda x: x IS NOT NULL), ',') AS reasons FROM li) WHERE reasons <> '' GROUP BY entity, reasons")
def quarantine_counts(spark, d):
    bad = rel.refused(rel.tagged(lines(spark, d), [("SMALL", F.col("qty") < 5), ("RETURNED", F.col("flag") == "R")]))
    return bad.groupBy(F.lit("lines").alias("entity"), F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"), F.min("l_orderkey").alias("example"))


@query("SELECT 'not_null' AS kind, 1::BIGINT AS passed, 0::BIGINT AS failed UNION ALL SELECT 'range', (count(*) FILTER (WHERE n = 0))::BIGINT, (count(*) FILTER (WHERE n > 0))::BIGINT FROM (SELECT count(*) FILTER (WHERE qty < 5) AS n FROM li UNION ALL SELECT count(*) FILTER (WHERE price < 0) FROM li)")
def dq_pass_fail(spark, d):
    """Results as they are recorded, counted by kind."""
    found = q.evaluate([q.not_null("lines", ["ship"]), q.value_range("lines", "qty", 5), q.value_range("lines", "price", 0)], lambda _: lines(spark, d))
    table = q.result_frame(spark, found, "silver", "b1", datetime(2026, 9, 1))
    return table.groupBy("kind").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


@query("SELECT count(*) AS bronze, count(*) FILTER (WHERE qty < 5) AS quarantined, (count(*) FILTER (WHERE qty >= 5)) - count(DISTINCT CASE WHEN qty >= 5 THEN l_orderkey * 10 + l_linenumber END) AS duplicates, count(DISTINCT CASE WHEN qty >= 5 THEN l_orderkey * 10 + l_linenumber END) AS silver FROM li")
def balance_equation(spark, d):
    rows = rel.tagged(lines(spark, d), [("SMALL", F.col("qty") < 5)])
    kept = rel.newest(rel.passed(rows), ["l_orderkey", "l_linenumber"], ["ship", "price"])
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = n(lines(spark, d), "bronze").crossJoin(n(rel.refused(rows), "quarantined")).crossJoin(kept.agg(F.sum(F.col(rel.COPIES) - 1).alias("duplicates"), F.count("*").alias("silver")))  # one row each
    return out.select("bronze", "quarantined", "duplicates", "silver")


@query("SELECT 'events' AS check_name, max(ts)::DATE::VARCHAR AS newest, round(date_diff('second', max(ts), TIMESTAMP '2024-02-10 00:00:00') / 3600.0, 6) AS age_hours, date_diff('second', max(ts), TIMESTAMP '2024-02-10 00:00:00') / 3600.0 > 120 AS is_stale FROM events UNION ALL SELECT 'orders', max(o_orderdate)::DATE::VARCHAR, round(date_diff('second', max(o_orderdate), TIMESTAMP '2024-02-10 00:00:00') / 3600.0, 6), true FROM orders UNION ALL SELECT 'nothing', NULL, NULL, true", pre=False)
def freshness(spark, d):
    as_of = datetime(2024, 2, 10)
    seconds = lambda name, c: read(spark, d, name).withColumn(c, F.date_trunc("second", c))
    tables = [(seconds("events", "ts"), ops.Freshness("events", "events", "ts", 120, "")), (seconds("orders", "o_orderdate"), ops.Freshness("orders", "orders", "o_orderdate", 1080, "")), (seconds("events", "ts"), ops.Freshness("nothing", "events", "ts", 1e9, "", "false"))]
    out = rel.union([ops.ages(df, c, as_of) for df, c in tables])
    return out.select("check_name", txt(F.to_date("latest_value")).alias("newest"), F.round("age_hours", 6).alias("age_hours"), "is_stale")


@query("SELECT CASE WHEN count(*) FILTER (WHERE user_id = 7) > 0 THEN 7 ELSE arg_max(user_id, ts) END AS batch FROM events", pre=False)
def alert_batch_choice(spark, d):
    return ops.batch_to_judge(read(spark, d, "events").withColumnRenamed("user_id", "batch_id"), "ts", 7).withColumnRenamed("batch_id", "batch")
