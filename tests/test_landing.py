"""Landing by checkpoint, schemas of files, versions and their upkeep, publishing through a control table."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.operators.relational import gaps
from ledgerline.plans import silver
from ledgerline.sources import exports, ingest
from ledgerline.sources.catalog import Catalog, Metastore

ACCOUNTS = next(f for f in ingest.FEEDS if f.table == "bronze_accounts")
LINES = next(f for f in ingest.FEEDS if f.table == "bronze_applications")


def put(root, path, text):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text, encoding="utf-8")
    return file


@pytest.fixture
def lake(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "lake")), tmp_path / "in"


def rows(catalog, *columns):
    return sorted(tuple(r) for r in catalog.read("bronze_accounts").select(*columns).collect())


def test_files_are_read_by_their_own_header(lake):
    catalog, root = lake
    put(root, "core_banking/PL/accounts/1.csv", "account_id,open_date\nA1,2024-01-02\n")
    put(root, "core_banking/PL/accounts/2.csv", "\ufeffopen_date,account_id\n2024-01-03,A2\n")
    put(root, "core_banking/CZ/accounts/3.csv", "account_id;open_date;branch\nA3;2024-01-04;Brno, 1\nA4;2024-01-05\n")
    put(root, "core_banking/RO/accounts/4.csv", 'account_id\n"A,5"\n')
    put(root, "core_banking/XX/accounts/5.csv", "account_id\nA9\n")
    assert ingest.land(catalog, ACCOUNTS, str(root), "b1") == 5
    assert rows(catalog, "account_id", "open_date", "branch", "_country_feed") == [("A,5", None, None, "RO"), ("A1", "2024-01-02", None, "PL"), ("A2", "2024-01-03", None, "PL"), ("A3", "2024-01-04", "Brno, 1", "CZ"), ("A4", "2024-01-05", None, "CZ")]
    assert [r["account_id"] for r in catalog.read("bronze_accounts").where(f"{ingest.CORRUPT} IS NOT NULL").collect()] == ["A4"]


def test_a_second_run_reads_nothing_of_old_files(lake):
    """The old file is exchanged for another text; had it been read again, that would show."""
    catalog, root = lake
    first = put(root, "core_banking/PL/accounts/1.csv", "account_id\nA1\nA2\n")
    assert ingest.land(catalog, ACCOUNTS, str(root), "b1") == 2
    kept = os.stat(first)
    first.write_text("account_id\nX1\nX2\n")
    os.utime(first, (kept.st_atime, kept.st_mtime))
    put(root, "core_banking/PL/accounts/2.csv", "account_id\nA3\n")
    assert ingest.land(catalog, ACCOUNTS, str(root), "b2") == 1 and ingest.land(catalog, ACCOUNTS, str(root), "b3") == 0
    assert rows(catalog, "account_id", "_batch_id") == [("A1", "b1"), ("A2", "b1"), ("A3", "b2")]
    log = {(os.path.basename(r["source_file"]), r["batch_id"]): r["row_count"] for r in catalog.read(ingest.LOG).collect()}
    assert log == {("1.csv", "b1"): 2, ("2.csv", "b2"): 1}


@pytest.mark.parametrize("broken", ["bronze_accounts", ingest.LOG])
def test_a_crash_on_the_way_adds_nothing_twice(lake, monkeypatch, broken):
    """Broken off before the rows come into force, and between the rows and their log."""
    catalog, root = lake
    put(root, "core_banking/PL/accounts/1.csv", "account_id\nA1\nA2\n")
    swap = catalog.files.swap

    def failing(path, text):
        if broken in path:
            raise OSError("gone")
        swap(path, text)

    monkeypatch.setattr(catalog.files, "swap", failing)
    with pytest.raises(Exception, match="gone"):
        ingest.land(catalog, ACCOUNTS, str(root), "b1")
    assert catalog.exists("bronze_accounts") == (broken == ingest.LOG)
    monkeypatch.undo()
    assert ingest.land(catalog, ACCOUNTS, str(root), "b2") == 2
    assert catalog.read("bronze_accounts").count() == 2 and catalog.read(ingest.LOG).count() == 1


def test_lines_empty_files_and_feeds_without_a_folder(lake):
    catalog, root = lake
    assert ingest.land(catalog, LINES, str(root), "b1") == 0
    put(root, "los/applications/1.jsonl", '{"a": 1}\n\n{"b"')
    put(root, "los/applications/2.jsonl", "")
    put(root, "los/applications/note.txt", "no feed")
    assert ingest.land(catalog, LINES, str(root), "b1") == 3
    put(root, "core_banking/PL/accounts/1.csv", "account_id,open_date\n")
    assert ingest.land(catalog, ACCOUNTS, str(root), "b1") == 0 and catalog.read("bronze_accounts").columns[:2] == ["account_id", "open_date"]


def test_many_appends_become_one_version_and_old_ones_go(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for k in range(12):
        catalog.write(spark.range(k, k + 1).coalesce(1), "t", "append")
    began = catalog.read("t")
    catalog.compact("t", 1)
    assert len(catalog._versions("t")) == 1 and catalog.read("t").count() == 12
    assert catalog.vacuum(1.0) == [] and began.count() == 12  # too young to go
    catalog.write(spark.range(3), "stg_u")
    catalog.publish(["u"])
    catalog.write(spark.range(4), "stg_u")
    gone = catalog.vacuum(1.0, time.time() + 7200)
    assert len(gone) == 12 and all(g.startswith("t/") for g in gone)
    assert catalog.read("t").count() == 12 and catalog.read("u").count() == 3 and catalog.read("stg_u").count() == 4
    files = [f for _, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert len(files) == 1


def test_versions_of_unlike_schemas(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    catalog.write(spark.sql("SELECT 1 AS a"), "t")
    catalog.write(spark.sql("SELECT 'x' AS b, 2 AS a"), "t", "append")
    assert sorted(map(tuple, catalog.read("t").collect())) == [(1, None), (2, "x")]
    with pytest.raises(TypeError, match="a is string, was int"):
        catalog.write(spark.sql("SELECT 'y' AS a"), "t", "append")
    assert catalog.read("t").count() == 2
    assert catalog.write(spark.range(5), "u", counts={"n": F.count("*"), "s": F.sum("id")}) == {"n": 5, "s": 10}


def test_a_metastore_publishes_all_or_nothing(spark, monkeypatch):
    names = [f"t{k}" for k in range(4)]
    store = Metastore(spark, "ledger_control_test")
    try:
        for n in names:
            store.write(spark.range(1), f"stg_{n}")
        store.publish(names)
        for n in names:
            store.write(spark.range(2), f"stg_{n}")
        made = []
        view = store._view

        def failing(table, of=None):
            made.append(table)
            if len(made) == 3:
                raise OSError("gone")
            view(table, of)

        monkeypatch.setattr(store, "_view", failing)
        with pytest.raises(OSError):
            store.publish(names)
        assert [store.read(n).count() for n in names] == [1, 1, 1, 1]
        monkeypatch.undo()
        reader = store.read("t0")
        store.publish(names)
        assert [store.read(n).count() for n in names] == [2, 2, 2, 2] and reader.columns == ["id"]
        store.append(spark.range(3), "log", "one")
        store.append(spark.range(3), "log", "one")
        store.append(spark.range(2).withColumn("more", F.lit("x")), "log", "two")
        assert store.read("log").count() == 5 and store.read("log").where("more = 'x'").count() == 2 and store.read_version("log", "two").count() == 2
    finally:
        spark.sql("DROP DATABASE ledger_control_test CASCADE")


BALANCES = next(f for f in ingest.FEEDS if f.table == "bronze_balances")
HEAD = "account_id,snapshot_date,country_code,product_code,currency,balance_local,days_past_due,account_status"


def balances(*entries):
    return "\n".join([HEAD, *[f"{a},2024-01-31,PL,P1,PLN,{amount},0,ACTIVE" for a, amount in entries], f"TRL,{len(entries)},{sum(x for _, x in entries if x > 0)},,,,,"]) + "\n"


@pytest.mark.parametrize("crash", [False, True])
def test_a_resent_file_rewrites_only_its_buckets(lake, spark, crash, monkeypatch):
    catalog, root = lake
    entity = silver.BY_NAME["balances"]
    put(root, "core_banking/PL/balances/1.csv", balances(*[(f"A{k}", 100 + k) for k in range(60)], ("A0", 7), ("A1", -5)))
    ingest.land(catalog, BALANCES, str(root), "b1")
    first = silver.deliver(catalog, entity, "b1", ["P1"], 16)
    assert first == {"bronze": 63, "control": 1, "bad": 1, "new": 61, "buckets": 16}
    before = catalog._manifest("silver_balances")["parts"]
    files = {k: sorted(os.listdir(f"{catalog.root}/silver_balances/{v}/_bucket={k}")) for k, v in before.items()}
    began = catalog.read("silver_balances")
    put(root, "core_banking/PL/balances/2.csv", balances(("A5", 900), ("B1", 1)))
    ingest.land(catalog, BALANCES, str(root), "b2")
    if crash:
        swap = catalog.files.swap
        monkeypatch.setattr(catalog.files, "swap", lambda path, text: (_ for _ in ()).throw(OSError("gone")) if "silver_balances/" in path else swap(path, text))
        with pytest.raises(OSError):
            silver.deliver(catalog, entity, "b2", ["P1"], 16)
        monkeypatch.undo()
        assert catalog.read("silver_balances").count() == 60
    again = silver.deliver(catalog, entity, "b2", ["P1"], 16)
    after = catalog._manifest("silver_balances")["parts"]
    changed = {k for k in after if after[k] != before.get(k)}
    assert 1 <= len(changed) <= 2 == again["new"] and again["buckets"] == len(changed)
    assert {k: sorted(os.listdir(f"{catalog.root}/silver_balances/{after[k]}/_bucket={k}")) for k in after if k not in changed} == {k: f for k, f in files.items() if k not in changed}
    assert silver.deliver(catalog, entity, "b3", ["P1"], 16)["bronze"] == 0
    whole = silver.accepted(entity, silver.judged(entity, catalog.read("bronze_balances").where("account_id <> 'TRL'"), ["P1"]))
    shown = lambda df: sorted(map(tuple, df.select("account_id", "balance_local", "_deliveries", "_batch_id").collect()))
    assert shown(catalog.read("silver_balances")) == shown(whole) and len(shown(whole)) == 61
    assert catalog.read("silver_quarantine").count() == 1 and catalog.read("silver_control_totals").count() == 2
    assert began.count() == 60  # a reader that began before
    gone = catalog.vacuum(1.0, time.time() + 7200)
    assert shown(catalog.read("silver_balances")) == shown(whole) and len(gone) <= 3


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_tables_in_buckets_need_no_exchange(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), 3)
    facts = spark.range(300).selectExpr("concat('A', id % 90) AS account_id", "date_add(DATE'2024-01-31', cast(id / 90 AS int)) AS day", "id")
    for name, df in (("fact", facts), ("dim", spark.range(80).selectExpr("concat('A', id) AS account_id", "id AS n"))):
        catalog.write(df, f"stg_{name}", by="account_id")
    catalog.publish(["fact", "dim"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = Catalog(spark, str(tmp_path))
        fact, dim = again.read("fact"), again.read("dim")
        assert exchanges(fact.groupBy("account_id", "day").count()) == 0  # what unique() groups by
        assert exchanges(quality.with_parents(fact, [("account_id", dim, "account_id")])) == 0
        assert exchanges(fact.join(dim, "account_id")) == 0 and exchanges(facts.groupBy("account_id", "day").count()) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert quality.orphans(fact, "account_id", dim, "account_id").count() == 30 and quality.duplicates(fact, ["account_id", "day"]).first()["n"] == 300
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, facts.collect()))
    with pytest.raises(ValueError, match="written whole"):
        catalog.write(facts, "fact", "append", by="account_id")


def test_a_report_file_of_too_many_rows_is_refused(spark, tmp_path):
    assert exports.csv_file(spark.range(3), str(tmp_path / "a.csv"), ["id"], 3) == 3
    with pytest.raises(exports.TooLarge):
        exports.csv_file(spark.range(4), str(tmp_path / "b.csv"), ["id"], 3)
    assert not (tmp_path / "b.csv").exists()


def test_gaps(spark):
    present = spark.sql("SELECT * FROM VALUES (DATE'2024-01-31', 'a'), (DATE'2024-04-30', 'a'), (DATE'2024-02-29', NULL), (NULL, 'b') AS t(month_end, ccy)")
    keys = spark.sql("SELECT * FROM VALUES ('a'), ('b'), (CAST(NULL AS STRING)), ('a') AS t(ccy)")
    found = {(r["ccy"], str(r["from_month"]), str(r["to_month"]), r["months"]) for r in gaps(present, keys, "2024-01-31", "2024-05-31").collect()}
    assert found == {("a", "2024-02-29", "2024-03-31", 2), ("a", "2024-05-31", "2024-05-31", 1), ("b", "2024-01-31", "2024-05-31", 5), (None, "2024-01-31", "2024-01-31", 1), (None, "2024-03-31", "2024-05-31", 3)}
