"""Frames over the testdata that the queries share, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bucket, to_eur

CENTS = "decimal(12,2)"


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def txt(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast(CENTS).alias("qty"), F.col("l_extendedprice").cast(CENTS).alias("price"),
        F.col("l_discount").cast("decimal(6,2)").alias("discount"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_shipdate").cast("date").alias("ship"),
    )


def orders(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("st"), F.col("o_totalprice").cast(CENTS).alias("total"), day.alias("odate"), F.last_day(day).alias("m"))


def places(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = read(spark, d, "customer"), read(spark, d, "nation"), read(spark, d, "region")
    geo = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_regionkey", "r_name")  # 25 nations
    return c.join(F.broadcast(geo), c["c_nationkey"] == geo["n_nationkey"]).select("c_custkey", "n_nationkey", "n_name", "r_regionkey", "r_name")


def rate(month: str, region: str, extra: int = 0) -> Column:
    """The derived rate of a region in a month, an exact decimal; the average rate is 5 millionths above."""
    e6 = F.lit(200000 + extra) + 1000 * F.col(region) + 10 * ((F.year(month) - 1995) * 12 + F.month(month))
    return (e6.cast("decimal(9,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(9,6)")


def rates(spark: SparkSession, d: str) -> DataFrame:
    """month_end, ccy (the region's key as text), rate_end, rate_avg."""
    months = orders(spark, d).select(F.col("m").alias("month_end")).distinct().crossJoin(read(spark, d, "region").select("r_regionkey"))
    return months.select("month_end", F.col("r_regionkey").cast("string").alias("ccy"), rate("month_end", "r_regionkey").alias("rate_end"), rate("month_end", "r_regionkey", 5).alias("rate_avg"))


def facts(spark: SparkSession, d: str) -> DataFrame:
    """One row a line with its order, place, days past due, bucket, rates and converted amount."""
    o = orders(spark, d).join(places(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    dpd = F.abs(F.date_diff("ship", "odate")) % 180
    joined = lines(spark, d).join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("dpd", dpd).withColumn("rate_end", rate("m", "r_regionkey")).withColumn("rate_avg", rate("m", "r_regionkey", 5))
    return joined.withColumn("bucket", bucket("dpd")).withColumn("bucket_order", bucket("dpd", True)).withColumn("eur", to_eur("price", "rate_end"))


def judged(spark: SparkSession, checks, tables: dict[str, DataFrame]) -> DataFrame:
    """The results of checks over these tables: check_name, rows_checked, rows_failed, passed, detail."""
    from ..operators import quality

    results = quality.evaluate(checks, tables.__getitem__)
    return spark.createDataFrame([(r.id, r.rows_checked, r.rows_failed, r.passed, r.detail) for r in results], "check_name string, rows_checked bigint, rows_failed bigint, passed boolean, detail string")


PRE = """
WITH li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::DECIMAL(12,2) AS qty, l_extendedprice::DECIMAL(12,2) AS price, l_discount::DECIMAL(6,2) AS discount, l_returnflag AS flag, l_linestatus AS status, l_shipdate::DATE AS ship FROM lineitem),
o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS st, o_totalprice::DECIMAL(12,2) AS total, o_orderdate::DATE AS odate, last_day(o_orderdate::DATE) AS m FROM orders),
pl AS (SELECT c_custkey, n_name, r_regionkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
f0 AS (SELECT *, abs(datediff('day', odate, ship)) % 180 AS dpd,
  ((200000 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6) AS rate_end,
  ((200005 + 1000 * r_regionkey + 10 * ((year(m) - 1995) * 12 + month(m)))::DECIMAL(9,0) * 0.000001::DECIMAL(7,6))::DECIMAL(9,6) AS rate_avg
  FROM li JOIN o ON l_orderkey = o_orderkey JOIN pl ON o_custkey = c_custkey),
f AS (SELECT *, CASE WHEN dpd = 0 THEN 'Current' WHEN dpd <= 29 THEN '1-29' WHEN dpd <= 59 THEN '30-59' WHEN dpd <= 89 THEN '60-89' ELSE '90-179' END AS bucket,
  CASE WHEN dpd = 0 THEN 0 WHEN dpd <= 29 THEN 1 WHEN dpd <= 59 THEN 2 WHEN dpd <= 89 THEN 3 ELSE 4 END AS bucket_order,
  round(price * rate_end, 2)::DECIMAL(18,2) AS eur FROM f0)
"""

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, pre: bool = True):
    """Registers a query under its function's name, with its SQL twin."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (PRE if pre else "") + sql
        return f

    return register
