"""The layers over generated files: what was put in comes out, faults are found, and everything around a run."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline import __main__ as command
from ledgerline import ops, session
from ledgerline.operators import legacy, measures, quality, reconcile
from ledgerline.operators.relational import month_ends
from ledgerline.plans import checks, gold, reconciliation, runner
from ledgerline.sources import exports, generate
from ledgerline.sources.catalog import Catalog, Metastore


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root, lake = str(tmp_path_factory.mktemp("landing")), str(tmp_path_factory.mktemp("lake"))
    made = generate.landing(spark, root, 120, 7)
    catalog = Catalog(spark, lake)
    return catalog, root, made, runner.run(catalog, root, "b1", reconcile=True, monitor=False)


def test_what_was_put_in_comes_out(done, spark):
    catalog, root, made, ran = done
    audit = {r[1]: dict(zip(("bronze", "control", "quarantined", "duplicates", "silver"), r[2:7])) for r in ran["silver"]}
    assert audit["balances"] == {"bronze": made["balances"] + made["resent_balances"] + made["bad_balances"] + made["trailers"], "control": made["trailers"], "quarantined": made["bad_balances"], "duplicates": made["resent_balances"], "silver": made["balances"]}
    assert audit["application_events"]["quarantined"] == made["cut_events"] and audit["application_events"]["silver"] == made["accounts"] + made["undecided_events"]
    assert audit["repayments"]["silver"] == made["repayments"] and catalog.read("silver_applications").where("status = 'PENDING'").count() == 0
    truth = spark.read.parquet(f"{root}/_truth/balances").select("account_id", "snapshot_date", F.col("balance").alias("b"), F.col("days_past_due").alias("d"))
    both = catalog.read("fact_balance_snapshot").join(truth, ["account_id", "snapshot_date"], "full")
    assert both.where("NOT (balance_local <=> b) OR NOT (days_past_due <=> d)").count() == 0
    assert catalog.read("silver_quarantine").select("entity").distinct().count() == 2
    assert {(r["check_name"], r["severity"]) for r in catalog.read("dq_results").where("NOT passed").collect()} <= {("silver_load_audit.quarantine_rate_application_events", "WARN")}  # one of a hundred lines is cut
    assert catalog.read("dq_results").count() == 96
    again = runner.run(catalog, root, "b2", monitor=False)
    assert sum(again["bronze"].values()) == 0 and catalog.read("fact_balance_snapshot").count() == made["balances"]


def test_the_bridge_closes_and_nothing_is_unexplained(done):
    catalog, _, _, ran = done
    numbers = ran["reconciliation"]
    assert numbers["unexplained_cells"] == numbers["bridge_rows_that_do_not_close"] == 0
    assert numbers["legacy_faults_found"] == 3 and numbers["cells_compared"] == 24 * 4 * 7 and numbers["definition_changes"] >= 3
    found = {r["cause_id"]: r for r in catalog.read("recon_findings_summary").collect()}
    assert len(found) == 11 and str(found["F1"]["first_month"]) >= "2025-03-31" and found["F2"]["scopes"] == "GROUP, RO" and "dpd30_rate" in found["F3"]["kpis"]
    left = catalog.read("recon_trail").where("round = '3'").agg(F.sum("months_affected")).first()[0]
    first = catalog.read("recon_trail").where("round = '0'").agg(F.sum("months_affected")).first()[0]
    assert left == 0 < first
    assert "check which month the formula reads" in catalog.read("recon_trail").where("round = '0' AND scope = 'PL' AND kpi = 'dpd30_rate'").first()["diagnosis"]


def test_an_error_of_the_new_model_is_unexplained_and_raises_the_alarm(done, spark, tmp_path):
    catalog, _, _, _ = done
    kpis = catalog.read(checks.KPI)  # the files of this version stay where they are
    wrong = (F.col("month_end") == "2026-08-31") & (F.col("scope") == "PL") & (F.col("kpi") == "portfolio_balance_eur")
    catalog.write(kpis.withColumn("value", F.when(wrong, F.col("value") + 0.11).otherwise(F.col("value"))), checks.KPI)
    try:
        numbers = reconciliation.run(catalog, str(tmp_path / "out"))
        assert numbers["unexplained_cells"] == 1 and numbers["bridge_rows_that_do_not_close"] == 0
        row = catalog.read("recon_attribution").where("classification = 'UNEXPLAINED'").first()
        assert (row["scope"], row["kpi"], round(row["amount"], 2)) == ("PL", "portfolio_balance_eur", 0.11)
        with pytest.raises(ops.CriticalAlert, match="RECONCILIATION_UNEXPLAINED"):
            ops.monitor(catalog, "b2", datetime(2026, 9, 1))
        alerts = {r["alert"]: r["fired"] for r in catalog.read(ops.ALERTS_TABLE).collect()}
        assert [a for a, fired in alerts.items() if fired and a in ("PIPELINE_FAILED", "QUALITY_ERROR", "GOLD_BEHIND_SILVER")] == [] and set(alerts) == {a.name for a in ops.ALERTS}
        files = sorted(os.listdir(tmp_path / "out"))
        assert [f for f in files if not f.startswith(".")] == ["attribution.csv", "bridge.csv", "diagnosis.csv", "findings.md", "findings_summary.csv", "reconciliation_summary.json", "trail.csv"]
        assert json.loads((tmp_path / "out/reconciliation_summary.json").read_text())["unexplained_cells"] == 1
        assert "no known cause" not in (tmp_path / "out/findings.md").read_text().split("## Causes")[0] and "## Unexplained" in (tmp_path / "out/findings.md").read_text()
        assert (tmp_path / "out/bridge.csv").read_text().count("\n") == 24 * 4 * 7 + 1
    finally:
        catalog.write(kpis, checks.KPI)
        reconciliation.run(catalog)


def test_a_fix_that_changes_other_cells_is_refused(done):
    catalog, _, _, _ = done
    rows = reconciliation.sheet(catalog).where(F.col("month_end").isin(month_ends(*checks.WINDOW)))
    found = legacy.require_cells(rows, None, "RO")
    assert all(n > 0 for n in found.values()) and legacy.require_cells(rows, found, "RO") == found
    with pytest.raises(legacy.FixDidNotApply, match="F2 changes no cell"):
        legacy.require_cells(rows, None, "XX")
    with pytest.raises(legacy.FixDidNotApply, match=f"F1 changes {found['F1']} cells, expected 1"):
        legacy.require_cells(rows, {"F1": 1}, "RO")


def test_measures_by_attributes_and_roles(done):
    catalog, _, made, _ = done
    model = measures.Model(catalog.read)
    for m in measures.MEASURES:
        assert model.evaluate(m.name, months=m.kind == "shifted" or "last month" in m.sql).columns[-1] == m.name
    total = model.evaluate("Portfolio balance (EUR)").first()[0]
    lines = {r[0]: r[1] for r in model.evaluate("Portfolio balance (EUR)", ["dim_product.product_line"]).collect()}
    assert set(lines) == {"Personal Loans", "Credit Cards"} and sum(lines.values()) == pytest.approx(total)
    last = catalog.read("fact_balance_snapshot").where("is_active AND date_key = 20260831")
    assert total == pytest.approx(float(last.agg(F.sum("balance_eur")).first()[0]))
    manager = measures.Model(catalog.read, "Poland country manager")
    assert [r[0] for r in manager.evaluate("New accounts", ["dim_country.country_name"]).collect()] == ["Poland"]
    assert manager.evaluate("New accounts").first()[0] == 40 == last.sparkSession.range(120).where("id % 3 = 0").count()
    assert manager.table("dim_customer").select("country_code").distinct().count() == 1
    assert measures.Model(catalog.read, "nobody").evaluate("New accounts").first()[0] == 0
    with pytest.raises(ValueError, match="no relationship"):
        model.evaluate("Applications received", ["dim_account.account_state"])
    columns = {t: set(catalog.read(t).columns) for t in ("fact_balance_snapshot", "fact_origination", "fact_application", "fact_repayment", "fx_rate_monthly", "dim_date", "dim_account", "dim_customer", "dim_product", "dim_country")}
    assert len(measures.RELATIONSHIPS) == 20 and all(c in columns[f] and k in columns[d] for f, c, d, k in measures.RELATIONSHIPS)


def test_sql_exports_and_the_command_line(done, spark, tmp_path, capsys):
    catalog, root, made, _ = done
    assert catalog.sql("SELECT count(*) AS n FROM fact_origination o JOIN dim_product p USING (product_code)").first()["n"] == made["accounts"]
    assert "fact_balance_snapshot" in catalog.tables() and not any(t.startswith("stg_") for t in catalog.tables())
    assert exports.kpi_csv(catalog, str(tmp_path / "kpi.csv")) == catalog.read(checks.KPI).count()
    lines = (tmp_path / "kpi.csv").read_text().splitlines()
    assert lines[0] == "month_end,scope,kpi,variant,value" and [x.split(",")[:4] for x in lines[1:]] == sorted(x.split(",")[:4] for x in lines[1:])
    small, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    assert command.main(["generate", "--out", small, "--accounts", "90", "--seed", "3"]) == 0
    assert json.loads(capsys.readouterr().out)["accounts"] == 90
    run = ["run", "--landing", small, "--lake", lake, "--batch", "c1", "--summary", str(tmp_path / "s.json"), "--kpi-csv", str(tmp_path / "k.csv")]
    assert command.main([*run, "--as-of", "2026-09-01T00:00:00"]) == 0
    summary = json.loads((tmp_path / "s.json").read_text())
    assert summary["gold"]["fact_origination"] == 90 and summary["kpi_rows"] == len((tmp_path / "k.csv").read_text().splitlines()) - 1
    with pytest.raises(ops.CriticalAlert, match="DATA_STALE: gold_month_end"):
        command.main([*run[:-4], "--as-of", "2027-01-01T00:00:00"])
    assert command.main(["reconcile", "--lake", lake]) == 0
    capsys.readouterr()
    assert command.main(["sql", "--lake", catalog.root, "SELECT max(date_key) AS newest FROM dim_date"]) == 0
    assert "20260831" in capsys.readouterr().out


def test_steps_are_retried_skipped_and_logged(spark, tmp_path):
    catalog, calls = Catalog(spark, str(tmp_path / "lake")), []

    def fails(times):
        def work(line):
            calls.append(1)
            if len(calls) <= times:
                raise RuntimeError("x" * 5000)
            line.update(rows=3, detail="fine")

        return work

    steps = [runner.Activity("a", fails(1), retries=1), runner.Activity("b", lambda line: 1 / 0), runner.Activity("c", lambda line: calls.append("never")), runner.Activity("m", lambda line: calls.append("always"), (runner.SUCCEEDED, runner.FAILED, runner.SKIPPED), logged=False)]
    with pytest.raises(ZeroDivisionError):
        runner.chain(catalog, "b1", steps)
    assert calls == [1, 1, "always"]
    log = catalog.read(ops.RUN_LOG).orderBy("started_at").collect()
    assert [(r["step"], r["status"], r["rows_written"]) for r in log] == [("a", "FAILED", 0), ("a", "SUCCEEDED", 3), ("b", "FAILED", 0)]
    assert len(log[0]["detail"]) <= ops.DETAIL + 1 and log[0]["detail"].startswith("RuntimeError: xxx") and "ZeroDivisionError" in log[2]["detail"]
    ticks = iter([datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 0, 5)])
    with ops.logged_step(catalog, "b2", "timed", lambda: next(ticks)):
        pass
    assert catalog.read(ops.RUN_LOG).where("step = 'timed'").first()["seconds"] == 5.0


def test_alerts_judge_the_batch_that_is_monitored(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "lake"))
    by = {a.name: a for a in ops.ALERTS}
    assert [ops.judge(a, catalog, "b")[0] for a in ops.ALERTS if a.table != ops.FRESH] == [True, True, True, False, False]
    t = lambda h: datetime(2026, 9, 1, h)
    rows = [("old", "silver", "SUCCEEDED", 1.0, 0, "", t(1), t(1)), ("old", "gold", "FAILED", 1.0, 0, "", t(2), t(2)), ("new", "silver", "SUCCEEDED", 1.0, 0, "", t(3), t(3)), ("new", "gold", "SUCCEEDED", 1.0, 0, "", t(4), t(4))]
    catalog.write(spark.createDataFrame(rows, ops.RUN_SCHEMA), ops.RUN_LOG)
    assert ops.judge(by["PIPELINE_FAILED"], catalog, "old") == (True, "gold") and not ops.judge(by["PIPELINE_FAILED"], catalog, "new")[0]
    assert not ops.judge(by["PIPELINE_FAILED"], catalog, "unknown")[0] and not ops.judge(by["GOLD_BEHIND_SILVER"], catalog, "new")[0]
    catalog.write(spark.createDataFrame([("new", "silver", "SUCCEEDED", 1.0, 0, "", t(5), t(5))], ops.RUN_SCHEMA), ops.RUN_LOG, "append")
    assert ops.judge(by["GOLD_BEHIND_SILVER"], catalog, "new")[0]
    failed = [quality.Result(quality.Check("t", f"c{k}", "expression", "WARN" if k == 9 else "ERROR"), 10, 1) for k in range(10)]
    catalog.write(quality.result_frame(spark, failed, "silver", "new", t(5)), ops.DQ)
    assert ops.judge(by["QUALITY_ERROR"], catalog, "new") == (True, "t.c0, t.c1, t.c2, t.c3, t.c4 and 4 more") and ops.judge(by["QUALITY_WARNING"], catalog, "new") == (True, "t.c9")
    fresh = {r["check_name"]: (r["is_stale"], r["age_hours"]) for r in ops.freshness(catalog, t(6)).collect()}
    assert fresh == {"gold_month_end": (True, None), "silver_loaded": (True, None), "quality_checked": (False, 1.0), "pipeline_succeeded": (False, 1.0)}


def test_a_broken_publication_is_completed(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "lake"))
    for k in (1, 2):
        for t in ("x", "y"):
            catalog.write(spark.range(k), f"stg_{t}")
        if k == 1:
            catalog.publish(["x", "y"])
    held = {t: catalog._manifest(f"stg_{t}") for t in ("x", "y")}
    moves = {t: m | {"versions": [f"../stg_{t}/{v}" for v in m["versions"]]} for t, m in held.items()}
    catalog.files.swap(catalog._path("_PUBLISH"), json.dumps(moves))  # the journal is written, then the driver dies
    assert catalog.read("x").count() == 1
    after = Catalog(spark, str(tmp_path / "lake"))
    assert after.read("x").count() == after.read("y").count() == 2 and not after.files.exists(after._path("_PUBLISH"))
    with pytest.raises(FileNotFoundError):
        after.read("none")
    read = after.staged(["x"])
    assert read("x").count() == 2 and read("x") is read("x")


def test_metastore_tables(spark):
    store = Metastore(spark, "ledger_test")
    try:
        store.write(spark.range(3).withColumnRenamed("id", "a"), "plain")
        store.write(spark.range(2).withColumnRenamed("id", "a"), "plain", "append")
        store.write(spark.range(1), "stg_t")
        store.publish(["t"])
        store.write(spark.range(9), "stg_t")
        assert store.read("plain").count() == 5 and store.read("t").count() == 1 and store.staged(["t"])("t").count() == 9
        assert store.exists("plain") and not store.exists("none")
        store.publish(["t"])
        assert store.sql("SELECT count(*) AS n FROM t").first()["n"] == 9
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE ledger_test CASCADE")


def test_sessions(spark):
    assert session.session().conf.get("spark.sql.session.timeZone") == "UTC"


def test_kpis_of_the_run(done):
    catalog, _, made, _ = done
    kpi = catalog.read(checks.KPI)
    opened = kpi.where("kpi = 'new_accounts' AND scope = 'GROUP'").agg(F.sum("value")).first()[0]
    assert opened == made["accounts"]
    b = catalog.read("fact_balance_snapshot").where("is_active AND date_key = 20260831 AND country_code = 'CZ'")
    want = b.agg(F.sum("balance_eur").alias("b"), F.sum(F.when(F.col("days_past_due") >= 30, F.col("balance_eur")).otherwise(0)).alias("l"), F.countDistinct("customer_id").alias("c")).first()
    got = {(r["kpi"], r["variant"]): r["value"] for r in kpi.where("scope = 'CZ' AND month_end = DATE'2026-08-31'").collect()}
    assert got["portfolio_balance_eur", "new"] == pytest.approx(float(want["b"])) and got["dpd30_rate", "new"] == pytest.approx(float(want["l"] / want["b"])) and got["avg_balance_per_customer_eur", "new"] == pytest.approx(float(want["b"]) / want["c"])
    assert len(reconcile.CHANGES) == 8 and [c.id for c in reconcile.CHANGES] == [f"D{k}" for k in range(1, 9)]
    assert set(gold.TABLES) | {"dim_date", "dim_country"} <= set(catalog.tables())


def test_a_stream_reads_each_file_once(spark, tmp_path):
    from ledgerline import streaming

    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    work = f"file://{tmp_path}/work"
    assert streaming.land(spark, str(tmp_path / "in"), work).count() == 5
    assert streaming.land(spark, str(tmp_path / "in"), work).count() == 5
    spark.range(2).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    landed = streaming.land(spark, str(tmp_path / "in"), work)
    assert landed.count() == 7 and landed.select("_source_file").distinct().count() == 2
    file = next(f for f in os.listdir(tmp_path / "in") if f.endswith(".parquet"))
    os.rename(tmp_path / "in" / file, tmp_path / "one.parquet")
    spark.range(9).coalesce(1).write.parquet(str(tmp_path / "one.parquet.more"))
    alone = streaming.land(spark, str(tmp_path / "one.parquet"))
    assert alone.count() in (2, 5) and alone.columns[0] == "id"
