"""Scans, projections, parsing, predicates, rules, deduplication, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import relational as rel
from ..plans import checks, silver
from .base import big, dbl, judged, lines, orders, query, rates, read, rate, places, txt


@query("SELECT o_orderkey, total::DOUBLE AS total, strftime(odate, '%Y%m%d')::INTEGER AS date_key, year(odate)::INTEGER AS y, quarter(odate)::INTEGER AS q, month(odate)::INTEGER AS mo, strftime(odate, '%b') AS month_name, strftime(odate, '%Y-%m') AS year_month, odate = m AS is_month_end FROM o")
def scan_project_typed(spark, d):
    o = orders(spark, d)
    return o.select("o_orderkey", dbl("total").alias("total"), fn.date_key("odate").alias("date_key"), F.year("odate").alias("y"), F.quarter("odate").alias("q"), F.month("odate").alias("mo"), F.date_format("odate", "MMM").alias("month_name"), F.date_format("odate", "yyyy-MM").alias("year_month"), fn.is_month_end("odate").alias("is_month_end"))


@query("SELECT p_partkey, upper(nullif(trim('  ' || lower(p_brand) || ' '), '')) AS brand, nullif(trim('   '), '') IS NULL AS blank_is_null FROM part", pre=False)
def clean_code_repair(spark, d):
    return read(spark, d, "part").select("p_partkey", fn.code(F.concat(F.lit("  "), F.lower("p_brand"), F.lit(" "))).alias("brand"), fn.text(F.lit("   ")).isNull().alias("blank_is_null"))


@query("SELECT o_orderkey, replace(replace(total::VARCHAR, '.', ','), ',', '.')::DECIMAL(18,2)::DOUBLE AS amount FROM o")
def locale_decimal_parse(spark, d):
    return orders(spark, d).select("o_orderkey", dbl(fn.number(F.translate(txt("total"), ".", ","), ",")).alias("amount"))


@query("SELECT o_orderkey, strptime(strftime(odate, '%d/%m/%Y'), '%d/%m/%Y')::DATE::VARCHAR AS day FROM o")
def locale_date_parse(spark, d):
    return orders(spark, d).select("o_orderkey", txt(fn.date(F.date_format("odate", "dd/MM/yyyy"), "%d/%m/%Y")).alias("day"))


@query("SELECT count(*) AS n, count(TRY_CAST(p_brand AS DECIMAL(18,2))) AS parsed, count(*) FILTER (WHERE TRY_CAST(p_brand AS DECIMAL(18,2)) IS NULL AND nullif(trim(p_brand), '') IS NOT NULL) AS failed FROM part", pre=False)
def try_parse_nulls(spark, d):
    p = read(spark, d, "part").select("p_brand", fn.number("p_brand").alias("v"), fn.date("p_brand").alias("day"))
    return p.agg(F.count("*").alias("n"), F.count("v").alias("parsed"), F.count_if(fn.unparsed("v", "p_brand")).alias("failed"))


RULES = [("CHEAP", "price <= 2000"), ("SMALL", "qty < 5"), ("RETURNED", "flag = 'R'")]


@query("""SELECT reasons, count(*) AS n FROM (SELECT array_to_string(list_filter([CASE WHEN price <= 2000 THEN 'CHEAP' END, CASE WHEN qty < 5 THEN 'SMALL' END, CASE WHEN flag = 'R' THEN 'RETURNED' END], lambda x: x IS NOT NULL), ',') AS reasons FROM li) GROUP BY reasons""")
def rules_reasons(spark, d):
    rows = rel.tagged(lines(spark, d), [(n, F.expr(e)) for n, e in RULES])
    both = rel.passed(rows).withColumn("reasons", F.array().cast("array<string>")).unionByName(rel.refused(rows))
    return both.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE coalesce(nullif(st, 'P') = 'F', true)) AS failed, count(*) FILTER (WHERE NOT coalesce(nullif(st, 'P') = 'F', true)) AS passed FROM o")
def null_rule_fails(spark, d):
    rows = rel.tagged(orders(spark, d), [("FINISHED", F.nullif("st", F.lit("P")) == "F")])
    return rel.refused(rows).agg(F.count("*").alias("failed")).crossJoin(rel.passed(rows).agg(F.count("*").alias("passed")))  # one row each


def delivered(spark, d, *columns):
    """Rows as a feed delivers them: as text, with lineage; a month of orders is a file."""
    o = orders(spark, d)
    raw = F.struct(*[txt(c).alias(c) for c in columns], F.lit(None).cast("string").alias("left_out"))
    return o.withColumns({"_raw": raw, "_source_file": F.concat(F.lit("landing/"), txt("m"), F.lit(".csv")), "_batch_id": F.lit("b1")})


@query("""SELECT 'orders' AS entity, 'OPEN' || CASE WHEN total > 100000 THEN ',LARGE' ELSE '' END AS reasons, 'landing/' || m::VARCHAR || '.csv' AS source_file, '{"o_orderkey":"' || o_orderkey || '","st":"' || st || '"}' AS raw_record, 'b1' AS batch_id FROM o WHERE st = 'P'
UNION ALL SELECT 'orders', 'LARGE', 'landing/' || m::VARCHAR || '.csv', '{"o_orderkey":"' || o_orderkey || '","st":"' || st || '"}', 'b1' FROM o WHERE st <> 'P' AND total > 100000""")
def quarantine_json(spark, d):
    rows = rel.tagged(delivered(spark, d, "o_orderkey", "st"), [("OPEN", F.col("st") == "P"), ("LARGE", F.col("total") > 100000)])
    return rel.quarantine(rows, "orders").drop("quarantined_at")


@query("""SELECT (n - (month(m) = 3)::INTEGER)::BIGINT AS expected_rows, 'PL' AS country_feed, 'landing/' || m::VARCHAR AS source_file, s::DOUBLE AS expected_amount FROM (SELECT m, count(*) AS n, sum(total) AS s FROM o GROUP BY m)""")
def trailer_control_totals(spark, d):
    return silver.trailers(balances_as_delivered(spark, d)).select("expected_rows", "country_feed", "source_file", dbl("expected_amount").alias("expected_amount"))


def balances_as_delivered(spark, d):
    """Orders as a file of balances a month, each closed by its control line; in March the line announces one row less."""
    o = orders(spark, d).select(txt("o_orderkey").alias("account_id"), txt("odate").alias("snapshot_date"), txt("st").alias("country_code"), txt("total").alias("balance_local"), "m", "total")
    last = o.groupBy("m").agg(F.lit("TRL").alias("account_id"), txt(F.count("*") - F.when(F.month("m") == 3, 1).otherwise(0)).alias("snapshot_date"), txt(F.sum("total")).alias("country_code"), F.lit(None).cast("string").alias("balance_local"))
    named = o.drop("total").unionByName(last)
    return named.select("account_id", "snapshot_date", "country_code", "balance_local", F.concat(F.lit("landing/"), txt("m")).alias("_source_file"), F.lit("PL").alias("_country_feed"), F.lit("b1").alias("_batch_id"))


@query("SELECT count(*) AS rows_checked, count(*) FILTER (WHERE month(m) = 3) AS rows_failed FROM (SELECT DISTINCT m FROM o)")
def dq_control_totals(spark, d):
    rows = balances_as_delivered(spark, d)
    return judged(spark, [checks.control_totals()], {"bronze_balances": rows, "silver_control_totals": silver.trailers(rows)}).select("rows_checked", "rows_failed")


@query("SELECT l_orderkey, l_linenumber, ship::VARCHAR AS ship, price::DOUBLE AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship DESC, price DESC, l_partkey DESC, l_suppkey DESC) AS k FROM li) WHERE k = 1")
def dedup_latest(spark, d):
    return rel.newest(lines(spark, d), ["l_orderkey", "l_linenumber"], ["ship", "price", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", txt("ship").alias("ship"), dbl("price").alias("price"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS k FROM events) WHERE k = 1", pre=False)
def current_state_events(spark, d):
    return rel.current_state(read(spark, d, "events"), "user_id", "ts").select("user_id", "event_id", "event_type")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_valid(substr(props, 1, 3)) AS cut_is_json FROM events", pre=False)
def json_struct_extract(spark, d):
    j = F.from_json("props", "k bigint")
    return read(spark, d, "events").select("event_id", j["k"].alias("k"), F.get_json_object(F.substring("props", 1, 3), "$").isNotNull().alias("cut_is_json"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier", pre=False)
def union_by_name_missing(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return rel.union([c, read(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))])


@query("SELECT o_orderkey FROM o WHERE st <> 'F'")
def anti_join_new_files(spark, d):
    """Orders are delivered anew each day; those that were finished have been taken before."""
    o = orders(spark, d)
    return rel.new_rows(o.select("o_orderkey"), o.where("st = 'F'"), "o_orderkey")


@query("SELECT strftime(t, '%Y%m%d')::INTEGER AS date_key, t::DATE::VARCHAR AS day, quarter(t)::INTEGER AS quarter, strftime(t, '%b') AS month_name, strftime(t, '%Y-%m') AS year_month, last_day(t)::VARCHAR AS month_end, t::DATE = last_day(t) AS is_month_end FROM (SELECT unnest(generate_series(min(odate)::TIMESTAMP, max(odate)::TIMESTAMP, INTERVAL 1 DAY)) AS t FROM o)")
def dim_date(spark, d):
    """The calendar from the first order to the last."""
    first, last = orders(spark, d).agg(F.min("odate"), F.max("odate")).first()
    return rel.calendar(spark, str(first), str(last)).select("date_key", txt("date").alias("day"), "quarter", "month_name", "year_month", txt("month_end").alias("month_end"), "is_month_end")


@query("SELECT band, count(*) AS n FROM (SELECT CASE WHEN age <= 29 THEN '18-29' WHEN age <= 44 THEN '30-44' WHEN age <= 59 THEN '45-59' ELSE '60+' END AS band FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN 18 + o_orderkey % 60 END AS age FROM o)) GROUP BY band")
def age_band_null_default(spark, d):
    age = F.when(F.col("o_orderkey") % 7 != 0, 18 + F.col("o_orderkey") % 60)
    return orders(spark, d).groupBy(fn.age_band(age).alias("band")).agg(F.count("*").alias("n"))


@query("SELECT state, count(*) AS n, count(*) FILTER (WHERE decisioned) AS decisioned, count(*) FILTER (WHERE approved) AS approved FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'WRITTEN_OFF' WHEN o_orderkey % 3 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS state, st IN ('F', 'O') AS decisioned, st = 'F' AS approved FROM o) GROUP BY state")
def state_precedence(spark, d):
    o = orders(spark, d).select(fn.account_state(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") % 3 == 0).alias("state"), F.col("st").isin("F", "O").alias("decisioned"), (F.col("st") == "F").alias("approved"))
    return o.groupBy("state").agg(F.count("*").alias("n"), F.count_if(F.expr("decisioned")).alias("decisioned"), F.count_if(F.expr("approved")).alias("approved"))


@query("""SELECT o_orderkey, round(total * ((200000 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6), 2)::DOUBLE AS eur_end,
round(total * ((200005 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6), 2)::DOUBLE AS eur_avg FROM o JOIN pl ON o_custkey = c_custkey""")
def fx_asof_month_join(spark, d):
    o = orders(spark, d).join(places(spark, d), F.col("o_custkey") == F.col("c_custkey")).withColumn("currency", txt("r_regionkey"))
    j = rel.rate_on(o, rates(spark, d), F.col("odate"))
    return j.select("o_orderkey", dbl(fn.to_eur("total", "rate_end")).alias("eur_end"), dbl(fn.to_eur("total", "rate_avg")).alias("eur_avg"))


@query("""SELECT count(*) FILTER (WHERE st <> 'F') AS not_f, count(*) FILTER (WHERE odate = last_day(odate)) AS month_ends, count(*) FILTER (WHERE total <= 100000) AS at_most, count(*) FILTER (WHERE total BETWEEN 1000 AND 50000) AS within,
count(*) FILTER (WHERE st LIKE '%F') AS ends_f, count(*) FILTER (WHERE st NOT IN ('F', 'O')) AS not_in, count(*) FILTER (WHERE odate <> DATE '1996-01-31') AS not_day, count(*) FILTER (WHERE abs(total - 100000) < 50000) AS near, count(*) FILTER (WHERE odate::VARCHAR IN ('1996-01-31', '1996-02-29')) AS listed FROM o""")
def predicate_battery(spark, d):
    tests = {"not_f": "st <> 'F'", "month_ends": "odate = last_day(odate)", "at_most": "total <= 100000", "within": "total BETWEEN 1000 AND 50000", "ends_f": "st LIKE '%F'", "not_in": "st NOT IN ('F', 'O')", "not_day": "odate <> DATE'1996-01-31'", "near": "abs(total - 100000) < 50000", "listed": "cast(odate AS string) IN ('1996-01-31', '1996-02-29')"}
    return orders(spark, d).agg(*[F.count_if(F.expr(e)).alias(n) for n, e in tests.items()])


@query("""SELECT l_orderkey, l_linenumber, s_name, coalesce(p_brand, 'UNMAPPED') AS brand FROM li LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey""")
def lookup_left_single_key(spark, d):
    """Lines with their supplier and the brand of their part, where the list has the part."""
    s, p = read(spark, d, "supplier"), read(spark, d, "part").where("p_size > 10")
    j = lines(spark, d).join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left").join(p, F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.select("l_orderkey", "l_linenumber", "s_name", F.coalesce("p_brand", F.lit("UNMAPPED")).alias("brand"))


@query("SELECT event_id, ts::DATE::VARCHAR AS day, ('http://h/a/b' || event_id || '.csv') AS path, 'b' || event_id || '.csv' AS base, lower(nullif(trim(CASE WHEN event_id % 2 = 0 THEN ' TRUE ' ELSE 'no' END), '')) = 'true' AS yes FROM events", pre=False)
def timestamp_and_basename(spark, d):
    path = F.concat(F.lit("http://h/a/b"), txt("event_id"), F.lit(".csv"))
    stamp = fn.instant(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return read(spark, d, "events").select("event_id", txt(F.to_date(stamp)).alias("day"), path.alias("path"), fn.basename(path).alias("base"), fn.flag(F.when(F.col("event_id") % 2 == 0, F.lit(" TRUE ")).otherwise(F.lit("no"))).alias("yes"))


@query("SELECT o_orderkey, date_sub('year', odate, DATE '2026-08-31')::INTEGER AS age FROM o")
def age_years(spark, d):
    return orders(spark, d).select("o_orderkey", fn.age_years("odate", F.lit("2026-08-31").cast("date")).alias("age"))


@query("SELECT DISTINCT user_id, event_type FROM events", pre=False)
def distinct_keys(spark, d):
    return read(spark, d, "events").select("user_id", "event_type").distinct()


@query("SELECT * FROM (SELECT l_orderkey, l_linenumber, price::DOUBLE AS price FROM li ORDER BY price DESC, l_orderkey, l_linenumber, l_partkey LIMIT 3)")
def topn_sample(spark, d):
    return lines(spark, d).orderBy(F.col("price").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(3).select("l_orderkey", "l_linenumber", dbl("price").alias("price"))


@query("SELECT EXISTS (SELECT 1 FROM li WHERE price > 100000) AS any_dear, EXISTS (SELECT 1 FROM li WHERE price > 100) AS any_row")
def exists_probe(spark, d):
    probe = lambda low: lines(spark, d).where(F.col("price") > low).limit(1)
    return probe(100000).agg((F.count("*") > 0).alias("any_dear")).crossJoin(probe(100).agg((F.count("*") > 0).alias("any_row")))


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY v DESC, ts DESC, event_id DESC) AS k FROM (SELECT *, 1 AS v FROM events UNION ALL SELECT event_id, ts, user_id, event_type, value + 1, props, 2 FROM events)) WHERE k = 1", pre=False)
def latest_delivery_resend(spark, d):
    e = read(spark, d, "events").withColumn("v", F.lit(1))
    again = e.withColumn("value", F.col("value") + 1).withColumn("v", F.lit(2))
    return rel.newest(rel.union([e, again]), ["user_id", "event_type"], ["v", "ts", "event_id"]).select("user_id", "event_type", "value")


@query("SELECT l_suppkey AS file, count(*) AS n FROM li GROUP BY l_suppkey")
def per_file_counts(spark, d):
    return lines(spark, d).groupBy(F.col("l_suppkey").alias("file")).agg(F.count("*").alias("n"))


@query("SELECT r AS round, st, count(*) AS n, sum(CASE WHEN r = 2 THEN total END)::DOUBLE AS mended FROM o, (VALUES (1), (2)) t(r) GROUP BY r, st")
def concat_rounds(spark, d):
    o = orders(spark, d)
    rounds = [o.select(F.lit(k).alias("round"), "st", *([F.col("total")] if k == 2 else [])) for k in (1, 2)]
    return rel.union(rounds).groupBy("round", "st").agg(F.count("*").alias("n"), dbl(F.sum("total")).alias("mended"))
