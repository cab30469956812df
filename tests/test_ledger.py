"""The stage ledger against counts taken apart from it."""

from panelforge.operators import clean as CL
from panelforge.operators.ledger import Ledger


def test_ledger_counts_rows_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None), (3, 4.0)], "k int, `v.x` double")
    ledger = Ledger(spark)
    a = ledger.run("load", df)
    b = ledger.run("clean", a, CL.remove_exact_duplicates)
    c = ledger.run("features", b, lambda x: x.selectExpr("k", "`v.x` * 2 AS w", "cast(NULL AS int) AS z").where("k < 3"))
    assert (a.count(), b.count(), c.count()) == (4, 3, 2)
    got = {r.stage: r for r in ledger.table().collect()}
    assert (got["load"].rows_before, got["load"].rows_after, got["load"].removed) == (None, 4, None)
    assert (got["clean"].rows_before, got["clean"].rows_after, got["clean"].removed, got["clean"].created) == (4, 3, 1, [])
    f = got["features"]
    assert (f.rows_before, f.rows_after, f.removed, f.created, f.dropped, f.columns_before, f.columns_after) == (3, 2, 1, ["w", "z"], ["v.x"], 2, 3)
    assert f.elapsed_s > 0 and len(f.finished) == 19
    assert sorted((r.column_name, r.nulls, r.pct) for r in ledger.nulls(created_only=True).where("stage = 'features'").collect()) == [("w", 1, 50.0), ("z", 2, 100.0)]
    assert [(r.stage, r.column_name, r.nulls) for r in ledger.nulls().where("position < 2").orderBy("position").collect()] == [("load", "v.x", 1), ("clean", "v.x", 1)]


def test_ledger_of_an_empty_table(spark):
    ledger = Ledger(spark)
    ledger.run("none", ledger.run("load", spark.createDataFrame([], "k int")), lambda x: x.where("k > 1"))
    assert [(r.rows_after, r.removed) for r in ledger.table().orderBy("position").collect()] == [(0, None), (0, 0)]


def test_preparation_writes_its_ledger(spark, sf):
    from panelforge.plans.prepare import LI_OPTS, prepare
    from panelforge.sources.tables import li_panel
    from panelforge.spec import LI_CUTOFFS, LI_PANEL

    ledger = Ledger(spark)
    p = prepare(li_panel(spark, sf), LI_PANEL, LI_CUTOFFS, LI_OPTS, ledger=ledger)
    stages = ledger.table().orderBy("position").collect()
    assert [s.stage for s in stages] == ["load", "features", "split", "impute"] and stages[-1].rows_after == p.data.count()
    assert ledger.nulls().where("stage = 'impute'").where(f"column_name in ({', '.join(repr(c) for c in p.imputed)})").count() == 0
