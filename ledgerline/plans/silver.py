"""Silver: entities declared as fields, rules and key; compiled to good, refused and duplicate rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import relational as rel
from ..sources.ingest import CORRUPT, COUNTRIES

# Statuses, product lines, the shape of an application event, and what makes a delivery newer than another.
ACCOUNT_STATUSES = ["ACTIVE", "CLOSED", "WRITTEN_OFF"]
APPLICATION_STATUSES = ["APPROVED", "DECLINED", "WITHDRAWN", "INCOMPLETE", "PENDING"]
PRODUCT_LINES = ["Personal Loans", "Credit Cards"]
EVENT = "application_id string, submitted_at string, channel string, applicant struct<customer_id string, country string, risk_grade string>, product struct<code string, requested_amount string, currency string>, decision struct<status string, decided_on string>, event_ts string"
DELIVERY = ["_ingested_at", "_source_modified_at", "_source_file"]


def _by_feed(of: Callable[[str, str], Column]) -> Column:
    """of(decimal mark, date format) of the country whose feed the row came by; the plain locale elsewhere."""
    chain = F
    for c in COUNTRIES:
        if (c.decimal, c.dates) != (".", "%Y-%m-%d"):
            chain = chain.when(F.col("_country_feed") == c.code, of(c.decimal, c.dates))
    return chain.otherwise(of(".", "%Y-%m-%d"))


def amount(name: str, kind: str = fn.MONEY) -> Column:
    return _by_feed(lambda mark, _: fn.number(name, mark, kind))


def day(name: str) -> Column:
    return _by_feed(lambda _, pattern: fn.date(name, pattern))


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    fields: Callable[[], dict[str, Column]]
    rules: Callable[[list[str]], list[tuple[str, Column]]]
    key: list[str]


def _c(name: str) -> Column:
    return F.col(name)


def _missing(*names: str) -> list[tuple[str, Column]]:
    return [(f"MISSING_{n.upper()}", _c(n).isNull()) for n in names]


def _feed() -> tuple[str, Column]:
    return ("COUNTRY_FEED_MISMATCH", _c("country_code") != _c("_country_feed"))


def _unread(code: str, name: str) -> tuple[str, Column]:
    return (code, fn.unparsed(name, _c("_raw")[name]))


def _codes(*names: str) -> dict[str, Column]:
    return {n: fn.code(n) for n in names}


# Column names, rule codes in their order, and keys.
ENTITIES = [
    Entity("products", "bronze_products", lambda: {**_codes("product_code"), "product_name": fn.text("product_name"), "product_line": fn.text("product_line"), "is_revolving": fn.flag("is_revolving"), "launch_date": fn.date("launch_date"), "annual_interest_rate": fn.number("annual_interest_rate", kind=fn.RATE)},
           lambda products: [*_missing("product_code"), ("INVALID_PRODUCT_LINE", ~_c("product_line").isin(PRODUCT_LINES))], ["product_code"]),
    Entity("fx_rates", "bronze_fx_rates", lambda: {"month_end": fn.date("month_end"), **_codes("currency"), **{n: fn.number(n, kind=fn.RATE) for n in ("rate_to_eur_month_end", "rate_to_eur_month_avg")}},
           lambda products: [("INVALID_MONTH_END", ~fn.is_month_end("month_end")), ("INVALID_RATE", (_c("rate_to_eur_month_end") <= 0) | _c("rate_to_eur_month_end").isNull() | (_c("rate_to_eur_month_avg") <= 0))], ["month_end", "currency"]),
    Entity("customers", "bronze_customers", lambda: {**_codes("customer_id", "country_code"), "date_of_birth": day("date_of_birth"), **_codes("employment_status"), "monthly_income_local": amount("monthly_income_local"), **_codes("risk_grade"), "customer_since": day("customer_since")},
           lambda products: [*_missing("customer_id"), _feed(), _unread("INVALID_DATE_OF_BIRTH", "date_of_birth"), _unread("INVALID_INCOME", "monthly_income_local")], ["customer_id"]),
    Entity("accounts", "bronze_accounts", lambda: {**_codes("account_id", "customer_id", "application_id", "country_code", "product_code", "currency"), "open_date": day("open_date"), "original_amount_local": amount("original_amount_local"), "term_months": fn.integer("term_months"), "annual_interest_rate": amount("annual_interest_rate", fn.RATE), "close_date": day("close_date"), "write_off_date": day("write_off_date"), "write_off_amount_local": amount("write_off_amount_local")},
           lambda products: [*_missing("account_id", "customer_id"), _feed(), ("UNKNOWN_PRODUCT", fn.not_in("product_code", products)), ("INVALID_OPEN_DATE", _c("open_date").isNull()), ("INVALID_AMOUNT", _c("original_amount_local") <= 0), _unread("INVALID_CLOSE_DATE", "close_date"), _unread("INVALID_WRITE_OFF_DATE", "write_off_date")], ["account_id"]),
    Entity("balances", "bronze_balances", lambda: {**_codes("account_id"), "snapshot_date": day("snapshot_date"), **_codes("country_code", "product_code", "currency"), "balance_local": amount("balance_local"), "days_past_due": fn.integer("days_past_due"), **_codes("account_status")},
           lambda products: [*_missing("account_id"), ("INVALID_SNAPSHOT_DATE", ~fn.is_month_end("snapshot_date")), _feed(), ("UNKNOWN_PRODUCT", fn.not_in("product_code", products)), ("INVALID_BALANCE", _c("balance_local") < 0), ("INVALID_DPD", _c("days_past_due") < 0), ("UNKNOWN_STATUS", fn.not_in("account_status", ACCOUNT_STATUSES))], ["account_id", "snapshot_date"]),
    Entity("repayments", "bronze_repayments", lambda: {**_codes("payment_id", "account_id"), "payment_date": day("payment_date"), "amount_local": amount("amount_local"), **_codes("currency", "payment_channel")},
           lambda products: [*_missing("payment_id", "account_id"), ("INVALID_PAYMENT_DATE", _c("payment_date").isNull()), ("INVALID_AMOUNT", _c("amount_local") <= 0)], ["payment_id"]),
    Entity("application_events", "bronze_applications", lambda: {
        "application_id": fn.code("_j.application_id"), "submitted_at": F.try_to_timestamp("_j.submitted_at"), "application_date": F.to_date(F.try_to_timestamp("_j.submitted_at")), "channel": F.upper("_j.channel"), "customer_id": F.upper("_j.applicant.customer_id"), "country_code": F.upper("_j.applicant.country"), "risk_grade": F.upper("_j.applicant.risk_grade"),
        "product_code": fn.code("_j.product.code"), "requested_amount_local": fn.number("_j.product.requested_amount"), "currency": F.upper("_j.product.currency"), "status": F.upper("_j.decision.status"), "decision_date": F.try_to_date("_j.decision.decided_on"), "event_ts": F.try_to_timestamp("_j.event_ts")},
           lambda products: [("MALFORMED_JSON", F.get_json_object(_c("_raw")["raw_json"], "$").isNull()), *_missing("application_id"), ("INVALID_EVENT_TS", _c("event_ts").isNull()), ("UNKNOWN_PRODUCT", fn.not_in("product_code", products)), ("UNKNOWN_STATUS", fn.not_in("status", APPLICATION_STATUSES))], ["application_id", "event_ts"]),
]
BY_NAME = {e.name: e for e in ENTITIES}


def _is_trailer() -> Column:
    return F.coalesce(F.col("account_id") == "TRL", F.lit(False))


def records(balances: DataFrame) -> DataFrame:
    """The delivered balances without the last lines of the files, with the amount as parsed."""
    return balances.where(~_is_trailer()).withColumn("amount", amount("balance_local"))


def trailers(balances: DataFrame) -> DataFrame:
    """Control totals: the count and amount that a file's last line announces, in its second and third field."""
    announced = {"source_file": F.col("_source_file"), "country_feed": F.col("_country_feed"), "expected_rows": F.col("snapshot_date").try_cast("bigint"), "expected_amount": amount("country_code"), "batch_id": F.col("_batch_id")}
    return balances.where(_is_trailer()).select(*[value.alias(name) for name, value in announced.items()])


def judged(entity: Entity, bronze: DataFrame, products: list[str]) -> DataFrame:
    """The typed rows, tagged with the rules they break; _raw is the row as delivered."""
    lineage = [c for c in bronze.columns if c.startswith("_") and c != CORRUPT]
    raw = bronze.withColumn("_raw", F.struct(*[c for c in bronze.columns if c not in lineage]))
    if entity.source == "bronze_applications":
        raw = raw.withColumn("_j", F.from_json("raw_json", EVENT))
    return rel.tagged(raw.select(*[c.alias(n) for n, c in entity.fields().items()], *lineage, "_raw"), entity.rules(products))


def accepted(entity: Entity, rows: DataFrame) -> DataFrame:
    """Silver rows: of each key the latest delivery, with the number of deliveries."""
    return rel.newest(rel.passed(rows), entity.key, [*DELIVERY, F.xxhash64(F.to_json("_raw"))]).drop("_raw", "_country_feed", "_source_modified_at", "_ingested_at")


#: Tables that lie in buckets of the key by which they are checked and joined to each other.
BY_KEY = {"silver_balances": "account_id", "silver_accounts": "account_id", "dim_account": "account_id", "fact_balance_snapshot": "account_id"}
AUDIT = "batch_id string, entity string, bronze_rows bigint, control_rows bigint, quarantined_rows bigint, duplicate_rows bigint, silver_rows bigint, loaded_at timestamp"


def run(catalog, batch: str, at) -> list[tuple]:
    """All entities. What was delivered is parsed and judged once, into a tagged table; the silver table and the refused rows are made
    of that. The numbers of the equation bronze = control + quarantined + duplicates + silver are counted on the way into these
    tables, each where it arises, so the equation can fail and nothing is read again to count it."""
    audit, products = [], []
    empty = True
    n = F.count("*")
    for e in ENTITIES:
        if not catalog.exists(e.source):
            continue
        bronze, control = catalog.read(e.source), F.lit(False)
        if e.name == "balances":
            catalog.write(trailers(bronze), "silver_control_totals")
            control = _is_trailer()
        delivered = bronze.withColumn("_control", control)
        tagged = judged(e, delivered, products)
        came = catalog.write(tagged, f"stg_tagged_{e.name}", counts={"bronze": n, "control": F.count_if("_control")})
        rows = catalog.read(f"stg_tagged_{e.name}").where("NOT _control").drop("_control")
        kept = catalog.write(accepted(e, rows), f"silver_{e.name}", counts={"silver": n, "again": F.coalesce(F.sum(F.col(rel.COPIES) - 1), F.lit(0))}, by=BY_KEY.get(f"silver_{e.name}"))
        bad = catalog.write(rel.quarantine(rows, e.name), "silver_quarantine", "overwrite" if empty else "append", counts={"bad": n})
        empty = False
        audit.append((batch, e.name, came["bronze"], came["control"], bad["bad"], kept["again"], kept["silver"], at))
        if e.name == "products":
            products = [r[0] for r in catalog.read("silver_products").select("product_code").collect()]  # a handful
        if e.name == "application_events":
            catalog.write(rel.current_state(catalog.read("silver_application_events"), "application_id", "event_ts"), "silver_applications")
    catalog.write(catalog.spark.createDataFrame(audit, AUDIT), "silver_load_audit", "append")
    return audit


def settled(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Silver rows of some buckets after a later delivery: its rows take the place of those of the same keys, the numbers of deliveries
    are added. Both sides have a row a key, so the joins do not multiply."""
    before = old.select(*[F.col(k).alias(f"_{k}") for k in key], F.col(rel.COPIES).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    again = new.join(before, same, "left").withColumn(rel.COPIES, F.col(rel.COPIES) + F.coalesce("_before", F.lit(0)))
    keys = new.select(*[F.col(k).alias(f"_{k}") for k in key])
    return old.join(keys, same, "left_anti").unionByName(again.select(*new.columns), allowMissingColumns=True)


def deliver(catalog, entity: Entity, batch: str, products: list[str], buckets: int = 64) -> dict[str, int]:
    """Brings what has come to bronze since the last call into the entity's silver table, which is kept by buckets of its key: only
    buckets that the delivery touches are read and written. Rows of a later call replace those of earlier ones, as they were landed
    later. Numbers of the delivery: bronze, control, bad, new (rows of good quality), and the buckets that were rewritten.

    Versions are taken one by one. Which of them are in the silver table stands in its manifest, which is swapped together with the rows; refused rows
    and control totals are appended under its name. So a call that is run again after a crash does what is left.
    """
    table = f"silver_{entity.name}"
    done = {"bronze": 0, "control": 0, "bad": 0, "new": 0, "buckets": 0}
    control = _is_trailer() if entity.name == "balances" else F.lit(False)
    known = set(catalog.taken(table))
    for version in [v for v in catalog.versions(entity.source) if v not in known]:
        bronze = catalog.read_version(entity.source, version)
        tagged = judged(entity, bronze.withColumn("_control", control), products)
        bad = F.count_if(~F.col("_control") & (F.cardinality(rel.REASONS) > 0))
        came = catalog.write(tagged, f"stg_tagged_{entity.name}", counts={"bronze": F.count("*"), "control": F.count_if("_control"), "bad": bad})
        rows = catalog.read(f"stg_tagged_{entity.name}").where("NOT _control").drop("_control")
        if entity.name == "balances":
            catalog.append(trailers(bronze), "silver_control_totals", version)
        catalog.append(rel.quarantine(rows, entity.name), "silver_quarantine", f"{entity.name}-{version}")
        touched = catalog.merge(accepted(entity, rows), table, entity.key, lambda old, new: settled(old, new, entity.key), buckets, [version])
        for name, n in (came | {"new": came["bronze"] - came["control"] - came["bad"], "buckets": len(touched)}).items():
            done[name] += n
    return done
