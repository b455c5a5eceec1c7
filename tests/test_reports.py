"""The legacy pack's lookup, the bridge in one evaluation, measures evaluated together."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import kpis, legacy, measures, reconcile

JAN, FEB, MAR = date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)
SUMS = "month_end date, scope string, loans decimal(28,2), cards_by_code decimal(28,2), cards_by_line decimal(28,2), late30 decimal(28,2), late90 decimal(28,2), all_local decimal(28,2), accounts bigint"
FLOWS = "month_end date, scope string, opened bigint, disbursed decimal(28,2), received bigint, approved bigint"


def sums(spark, *rows):
    return spark.createDataFrame([(m, s, D(loans), D(code), D(line), D(l30), D(l90), D(total), n) for m, s, loans, code, line, l30, l90, total, n in rows], SUMS)


def pack(spark, rates=((JAN, "PLN", "0.25"), (FEB, "PLN", "0.50"), (JAN, "RON", "0.20"), (FEB, "RON", "0.20"))):
    own = sums(spark, (JAN, "PL", 100, 40, 30, 10, 5, 130, 2), (JAN, "RO", 50, 0, 0, 0, 0, 50, 1), (FEB, "RO", 60, 0, 0, 6, 0, 60, 1))
    flows = spark.createDataFrame([(JAN, "PL", 1, D(10), 2, 1), (FEB, "PL", 3, D(30), 4, 4)], FLOWS)
    table = spark.createDataFrame([(m, c, D(r)) for m, c, r in rates], "month_end date, ccy string, rate_end decimal(18,8)")
    places = spark.createDataFrame([("PL", "PLN"), ("RO", "RON")], "scope string, ccy string")
    return legacy.sheet(own, table, places, flows)


def figures(spark, rows, **more):
    return {(r["month_end"], r["scope"], r["kpi"]): r for r in legacy.figures(rows, "RO", **more).collect()}


def test_a_month_with_originations_and_no_balances_has_its_rate(spark):
    """Poland has no balances in February; its originations are converted by February's rate all the same."""
    found = figures(spark, pack(spark))
    assert found[FEB, "PL", "new_originations_eur"]["legacy_published"] == 15.0
    assert found[FEB, "PL", "portfolio_balance_eur"]["legacy_published"] == 0.0
    assert found[FEB, "GROUP", "new_originations_eur"]["legacy_published"] == 15.0
    assert found[FEB, "PL", "new_accounts"]["legacy_after_F3"] == 3.0
    assert legacy.unrated(pack(spark)).count() == 0


def test_a_rate_that_is_not_found_is_no_number_and_stays_in_the_bridge(spark):
    rows = pack(spark, ((JAN, "PLN", "0.25"), (JAN, "RON", "0.20"), (FEB, "RON", "0.20")))
    found = figures(spark, rows)
    assert [tuple(r) for r in legacy.unrated(rows).collect()] == [(FEB, "PL")]
    assert found[FEB, "PL", "new_originations_eur"]["legacy_published"] is None and found[FEB, "GROUP", "new_originations_eur"]["legacy_published"] is None
    assert found[FEB, "PL", "new_accounts"]["legacy_published"] == 3.0 and found[FEB, "PL", "approval_rate"]["legacy_published"] == 1.0
    empty = spark.createDataFrame([], "month_end date, scope string, kpi string, variant string, value double")
    open_cells = reconcile.unexplained(reconcile.bridge(legacy.figures(rows, "RO"), empty))
    assert (FEB, "PL", "new_originations_eur") in [tuple(r) for r in open_cells.select(*reconcile.KEYS).collect()]


def test_one_evaluation_equals_the_tabs_stage_by_stage(spark):
    rows = pack(spark)
    found = figures(spark, rows)
    for name, fixed in legacy.stages():
        tabs = legacy.tab(rows, fixed, "RO")
        for r in tabs.unionByName(legacy.summary(tabs)).collect():
            for kpi in legacy.KPIS:
                assert found[r["month_end"], r["scope"], kpi][name] == pytest.approx(r[kpi], abs=1e-12)
    assert len(found) == len(legacy.KPIS) * (4 + 2)


def test_bridge_of_rows_equals_bridge_of_tables(spark):
    parts = [(JAN, "PL", 0, 130), (JAN, "RO", 0, 50), (FEB, "PL", 3, 0), (FEB, "RO", 0, 61)]
    columns = ["unrounded", "balance", "late30", "late90", "late30_unrounded", "late90_unrounded", "accounts", "customers", "opened", "originated", "originated_end", "originated_avg", "received", "decisioned", "approved"]
    new = spark.createDataFrame([(m, s, *[D(x) if c in ("unrounded", "balance") else D(o) for c in columns]) for m, s, o, x in parts], "month_end date, scope string, " + ", ".join(f"{c} decimal(18,2)" for c in columns))
    rows = pack(spark).join(new.withColumnsRenamed({c: f"{reconcile.GOLD}{c}" for c in columns}), legacy.SHEET)
    total = new.unionByName(new.groupBy("month_end").agg(*[F.sum(c).alias(c) for c in columns], F.lit("GROUP").alias("scope")))
    one, two = reconcile.bridge_of(rows, "RO"), reconcile.bridge(legacy.figures(pack(spark), "RO"), kpis.kpi_table(total))
    names = [*reconcile.KEYS, *[x.column for x in reconcile.CAUSES], "total_difference", "gold_published"]
    shown = lambda df: sorted([tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()], key=repr)
    assert shown(one) == shown(two)


def test_a_mended_fault_has_to_change_cells(spark):
    rows = pack(spark)
    counts = {(r["fault"], r["kpi"]): r["cells"] for r in legacy.cells_changed(rows, "RO").collect()}
    assert counts["F1", "portfolio_balance_eur"] == 1 and counts["F1", "new_accounts"] == 0  # 40 by code, 30 by line, in one cell
    assert counts["F2", "portfolio_balance_eur"] == 2 and counts["F3", "dpd30_rate"] == 2
    level = rows.withColumn("cards_by_code", F.col("cards_by_line"))
    with pytest.raises(legacy.FixDidNotApply, match="F1 changes no cell"):
        legacy.require_cells(level, None, "RO")


def test_equal_differences_name_the_first_scope(spark):
    rows = [("1", "r", s, "portfolio_balance_eur", 3, JAN, x, 0.1, "d") for s, x in (("GROUP", 7638.748689001426), ("AFRICA", 7638.748688999796), ("ASIA", 7000.0))]
    trail = spark.createDataFrame(rows, "round string, round_label string, scope string, kpi string, months_affected int, first_affected_month date, largest_difference double, largest_relative_difference double, diagnosis string")
    for order in (True, False):
        assert reconcile.trail_highlights(trail.orderBy("scope", ascending=order)).first()["scope"] == "AFRICA"


FACT = "r string, date_key int, is_active boolean, customer_id int, balance_eur double, is_dpd30 boolean, is_dpd90 boolean"


def test_measures_together_equal_each_alone(spark):
    balances = spark.createDataFrame([("a", 20240131, True, 1, 10.0, True, False), ("a", 20240229, True, 1, 20.0, False, False), ("a", 20240229, True, 2, 5.0, True, True), ("a", 20240331, False, 2, 9.0, False, False), ("b", 20240131, True, 3, 7.0, False, False), (None, 20240229, True, 4, 3.0, False, False)], FACT)
    flows = spark.createDataFrame([("a", 20240131, 4.0), ("c", 20240229, 6.0)], "r string, date_key int, amount_eur double")
    reads = []

    def read(table):
        reads.append(table)
        return balances if table == measures.BAL else flows

    names = [m.name for m in measures.MEASURES if m.table in (measures.BAL, measures.ORI, measures.PAY)]
    for months in (True, False):
        asked = [n for n in names if months or not any(m.kind == "shifted" for m in measures.needed([n]))]
        reads.clear()
        wide = {tuple(r[: 1 + months]): r for r in measures.evaluate_many(asked, read, ["r"], months).collect()}
        assert sorted(reads) == sorted([measures.BAL, measures.ORI, measures.PAY])  # each fact once
        for name in asked:
            alone = {tuple(r[: 1 + months]): r[name] for r in measures.evaluate(name, read, ["r"], months).collect()}
            assert {k: r[name] for k, r in wide.items() if r[name] is not None} == {k: v for k, v in alone.items() if v is not None}
    late = {tuple(r[:2]): r[2] for r in measures.evaluate("30+ DPD rate", read, ["r"], True).collect()}
    assert late == {("a", JAN): 1.0, ("a", FEB): 0.2, ("b", JAN): 0.0, (None, FEB): 0.0}
    before = measures.evaluate("Portfolio balance last month (EUR)", read, ["r"], True).where("r = 'b'").collect()
    assert {r["month_end"]: r[2] for r in before} == {JAN: None, FEB: 7.0}
    with pytest.raises(ValueError, match="needs months"):
        measures.evaluate("Portfolio balance MoM %", read)


def test_every_measure_is_described():
    assert set(measures.DESCRIPTIONS) == set(measures.BY_NAME) and all(m.description.endswith(".") for m in measures.MEASURES)


def test_a_missing_month_takes_its_place_in_a_trailing_sum(spark):
    df = spark.createDataFrame([(JAN, 1), (MAR, 10)], "m date, v int")
    assert [r["s"] for r in legacy.trailing(df, "m", "v", "s", 2).orderBy("m").collect()] == [1, 10]


@pytest.mark.parametrize("changed, codes", [((0, 12, -1, 0.0, 0.0, False, False), "nothing to do"), ((12, 12, 0, 0.01, 0.3, True, False), "look for a rate or factor typed into a formula"), ((5, 12, 3, 0.5, 0.3, False, False), "look at what was delivered or changed in 2024-01-31"), ((12, 12, 0, 0.5, 0.3, False, False), "trace one month by hand")])
def test_advice(spark, changed, codes):
    names = "months_affected int, months_in_series int, first_affected_index int, ratio_spread double, largest_relative_difference double, ratio_always_same_side boolean, legacy_zero_in_first_month boolean, first_affected_month date"
    assert reconcile.diagnose(spark.createDataFrame([(*changed, JAN)], names)).first()["diagnosis"] == codes
