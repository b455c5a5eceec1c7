"""Landed files of an invented portfolio: CSV in each country's locale with control lines, application events as JSON lines.

Everything follows from account numbers, months and a seed by hashing, so a portfolio of any size is made in parallel and is
the same each time. Known disturbances are put in, and what should become of them is returned: resent files (duplicates),
codes in the wrong case with blanks, balances of a future date, undecided events, cut lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Files
from .ingest import COUNTRIES, Country

# The products (code, name, line, revolving, launch, rate), one of which has a misleading code.
PRODUCTS = [
    ("PL_STD", "Standard loan", "Personal Loans", False, "2023-03-01", "0.1490"),
    ("PL_PLUS", "Loan plus", "Personal Loans", False, "2023-03-01", "0.1290"),
    ("CC_STD", "Standard card", "Credit Cards", True, "2023-03-01", "0.2190"),
    ("CC_GOLD", "Gold card", "Credit Cards", True, "2023-03-01", "0.1990"),
    ("CC_CONSOL", "Card debt consolidation loan", "Personal Loans", False, "2025-03-01", "0.1690"),
]
WINDOW = ("2024-09-30", "2026-08-31")
RATES = {"PLN": 0.231, "CZK": 0.0402, "RON": 0.2012}
_FORMATS = {"%Y-%m-%d": "yyyy-MM-dd", "%d/%m/%Y": "dd/MM/yyyy"}


def _draw(seed: int, name: str, *of: str) -> Column:
    """A number from 0 to 1 that follows from these columns."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(name), *of), F.lit(1_000_003)) / 1_000_003.0).cast("double")


def _pick(draw: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw * len(values)).cast("int") + 1)


def accounts(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """account_id, customer_id, application_id, country_code, product_code, currency, open_date, amount, term_months, rate."""
    k = spark.range(n).withColumn("c", (F.col("id") % len(COUNTRIES)).cast("int"))
    code, currency = _pick(F.col("c") / len(COUNTRIES), [c.code for c in COUNTRIES]), _pick(F.col("c") / len(COUNTRIES), [c.currency for c in COUNTRIES])
    number = F.lpad(F.col("id").cast("string"), 8, "0")
    opened = F.date_add(F.lit("2023-03-01").cast("date"), (_draw(seed, "open", "id") * 1200).cast("int"))
    early = _pick(_draw(seed, "product", "id"), [p[0] for p in PRODUCTS[:4]])
    late = _pick(_draw(seed, "product", "id"), [p[0] for p in PRODUCTS])
    rows = k.select("id", code.alias("country_code"), currency.alias("currency"), number.alias("number"), opened.alias("open_date"))
    return rows.select(
        "id", F.concat("country_code", "number").alias("account_id"), F.concat(F.lit("C"), "country_code", F.lpad(F.floor(F.col("id") / 6).cast("string"), 7, "0")).alias("customer_id"), F.concat(F.lit("A"), "country_code", "number").alias("application_id"), "country_code",
        F.when(F.col("open_date") >= "2025-03-01", late).otherwise(early).alias("product_code"), "currency", "open_date", F.round(500 + _draw(seed, "amount", "id") * 20_000, 2).cast("decimal(18,2)").alias("amount"), (12 + (_draw(seed, "term", "id") * 60).cast("int")).alias("term_months"),
    )


def balances(own: DataFrame, seed: int) -> DataFrame:
    """A row for each account and month end of the window from its opening on: balance falls, some fall behind for a while."""
    months = F.explode(F.expr(f"transform(sequence(0, 23), k -> last_day(add_months(DATE'{WINDOW[0]}', k)))")).alias("snapshot_date")
    rows = own.select("*", months).where(F.col("snapshot_date") >= F.last_day("open_date"))
    age = F.months_between("snapshot_date", F.last_day("open_date"))
    left = F.greatest(F.lit(0.0), 1 - age / F.col("term_months"))
    balance = F.round(F.col("amount") * left, 2).cast("decimal(18,2)")
    late = F.when(_draw(seed, "late", "id") < 0.2, (_draw(seed, "days", "id", "snapshot_date") * 170).cast("int")).otherwise(F.lit(0))
    closed = F.col("balance") == 0
    rows = rows.withColumn("balance", balance)
    return rows.withColumns({"days_past_due": F.when(closed, F.lit(0)).otherwise(late), "account_status": F.when(closed, F.lit("CLOSED")).otherwise(F.lit("ACTIVE"))})


def _line(country: Country, *fields: Column) -> Column:
    return F.concat_ws(country.separator, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]).alias("value")


def _money(country: Country, value: Column) -> Column:
    text = value.cast("decimal(18,2)").cast("string")
    return F.translate(text, ".", country.decimal) if country.decimal != "." else text


def _day(country: Country, value: str | Column) -> Column:
    return F.date_format(value, _FORMATS[country.dates])


def _csv(df: DataFrame, files: Files, path: str, header: list[str], country: Country | None = None, last: str | None = None) -> None:
    """One file: header, the lines in order, and what comes last."""
    lines = [(country.separator if country else ",").join(header), *[r["value"] for r in df.orderBy("value").toLocalIterator()]]
    files.swap(path, "\n".join([*lines, *([last] if last else [])]) + "\n")


def landing(spark: SparkSession, root: str, n: int = 500, seed: int = 42) -> dict:
    """Writes all files below root, and the true balances to root/_truth; the rows of each kind and the disturbances."""
    files, own = Files(spark), accounts(spark, n, seed).cache()
    every = balances(own, seed).cache()
    every.select("account_id", "snapshot_date", "balance", "days_past_due", "account_status").write.mode("overwrite").parquet(f"{root}/_truth/balances")
    files.swap(f"{root}/reference/products/products.csv", "product_code,product_name,product_line,is_revolving,launch_date,annual_interest_rate\n" + "".join(f"{a},{b},{c},{str(d).lower()},{e},{f}\n" for a, b, c, d, e, f in PRODUCTS))
    months = spark.sql("SELECT explode(transform(sequence(0, 41), k -> last_day(add_months(DATE'2023-03-31', k)))) AS m").collect()
    rate = lambda currency, k, shift: f"{RATES[currency] * (1 + 0.002 * (k % 7 - 3) + shift):.6f}"
    files.swap(f"{root}/treasury/fx_rates/rates.csv", "month_end,currency,rate_to_eur_month_end,rate_to_eur_month_avg\n" + "".join(f"{r['m']},{c},{rate(c, k, 0)},{rate(c, k, 0.001)}\n" for k, r in enumerate(months) for c in RATES))
    done = {"accounts": n, "balances": every.count(), "resent_balances": 0, "bad_balances": 0, "trailers": 0, "events": 0, "undecided_events": 0, "cut_events": 0, "repayments": 0}
    c = F.col
    for country in COUNTRIES:
        here, folder = own.where(c("country_code") == country.code), f"{root}/core_banking/{country.code}"
        people = here.select("customer_id", "country_code").distinct()
        _csv(people.select(_line(country, c("customer_id"), c("country_code"), _day(country, F.date_sub(F.lit("1990-01-01").cast("date"), (_draw(seed, "born", "customer_id") * 12000).cast("int"))), F.lit("EMPLOYED"), _money(country, 1000 + _draw(seed, "income", "customer_id") * 5000), _pick(_draw(seed, "grade", "customer_id"), list("ABCDE")), _day(country, F.lit("2023-03-01").cast("date")))), files, f"{folder}/customers/customers.csv", ["customer_id", "country_code", "date_of_birth", "employment_status", "monthly_income_local", "risk_grade", "customer_since"], country)
        blank = F.lit("")
        rate_ = F.lit("0,1490" if country.decimal == "," else "0.1490")
        _csv(here.select(_line(country, c("account_id"), c("customer_id"), c("application_id"), c("country_code"), c("product_code"), c("currency"), _day(country, "open_date"), _money(country, c("amount")), c("term_months"), rate_, blank, blank, blank)), files, f"{folder}/accounts/accounts.csv", ["account_id", "customer_id", "application_id", "country_code", "product_code", "currency", "open_date", "original_amount_local", "term_months", "annual_interest_rate", "close_date", "write_off_date", "write_off_amount_local"], country)
        mine = every.where(c("country_code") == country.code)
        untidy = F.when(c("id") % 17 == 0, F.concat(F.lit(" "), F.lower("product_code"), F.lit(" "))).otherwise(c("product_code"))
        line = _line(country, c("account_id"), _day(country, "snapshot_date"), c("country_code"), untidy, c("currency"), _money(country, c("balance")), c("days_past_due"), c("account_status"))
        header = ["account_id", "snapshot_date", "country_code", "product_code", "currency", "balance_local", "days_past_due", "account_status"]
        bad = mine.where((c("id") % 50 == 0) & (c("snapshot_date") == WINDOW[1])).select(_line(country, F.lit(""), _day(country, "snapshot_date"), c("country_code"), c("product_code"), c("currency"), _money(country, c("balance")), c("days_past_due"), c("account_status")))
        again = mine.where(c("snapshot_date") == WINDOW[1])
        for name, rows, extra in (("balances", mine, bad), ("balances_resent", again, None)):
            total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("balance"), F.lit(0)).alias("s")).first()
            lost = extra.count() if extra is not None else 0
            amount = total["s"] + (mine.where((c("id") % 50 == 0) & (c("snapshot_date") == WINDOW[1])).agg(F.coalesce(F.sum("balance"), F.lit(0))).first()[0] if extra is not None else 0)
            text = f"{amount:.2f}".replace(".", country.decimal)
            lines = rows.select(line) if extra is None else rows.select(line).unionByName(extra)
            _csv(lines, files, f"{folder}/balances/{name}.csv", header, country, country.separator.join(("TRL", str(total["n"] + lost), text)))
            done["trailers"] += 1
            done["bad_balances"] += lost
            done["resent_balances"] += total["n"] if extra is None else 0
        paid = mine.where("balance > 0").select(_line(country, F.concat(F.lit("P"), c("account_id"), F.date_format("snapshot_date", "yyMM")), c("account_id"), _day(country, F.date_sub("snapshot_date", 3)), _money(country, c("amount") / c("term_months") + 1), c("currency"), F.lit("CARD")))
        _csv(paid, files, f"{folder}/repayments/repayments.csv", ["payment_id", "account_id", "payment_date", "amount_local", "currency", "payment_channel"], country)
        done["repayments"] += paid.count()
    stamp = lambda day, hour: F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f"T{hour:02d}:00:00Z"))
    decided = F.when(_draw(seed, "decision", "id") < 0.7, "APPROVED").when(_draw(seed, "decision", "id") < 0.9, "DECLINED").otherwise("WITHDRAWN")

    def event(status: Column, hour: int) -> Column:
        return F.to_json(F.struct(
            c("application_id"), stamp("open_date", 8).alias("submitted_at"), F.lit("web").alias("channel"), F.struct(c("customer_id"), c("country_code").alias("country"), F.lit("A").alias("risk_grade")).alias("applicant"),
            F.struct(c("product_code").alias("code"), c("amount").cast("string").alias("requested_amount"), c("currency")).alias("product"), F.struct(status.alias("status"), F.date_format("open_date", "yyyy-MM-dd").alias("decided_on")).alias("decision"), stamp("open_date", hour).alias("event_ts"),
        )).alias("value")

    pending, cut = own.where("id % 20 = 0"), own.where("id % 100 = 7")
    whole = event(decided, 12)
    lines = own.select(whole).unionByName(pending.select(event(F.lit("PENDING"), 9))).unionByName(cut.select(whole).selectExpr("substring(value, 1, cast(length(value) / 2 AS int)) AS value"))
    files.swap(f"{root}/los/applications/events.jsonl", "".join(r["value"] + "\n" for r in lines.orderBy("value").toLocalIterator()))
    done |= {"events": lines.count(), "undecided_events": pending.count(), "cut_events": cut.count()}
    own.unpersist()
    every.unpersist()
    return done
