"""Train, rank, save, load in a new session, score, record: one chain."""

import tempfile

import pytest
from pyspark.sql import functions as F

from panelforge.operators import models as MD
from panelforge.operators import rank as R
from panelforge.operators import split as SP
from panelforge.plans import prepare as P
from panelforge.plans import q_models as Q
from panelforge.plans import serve as S
from panelforge.sources import files as IO
from panelforge.sources.sinks import BatchSink, KeyedTable
from panelforge.sources.tables import li_panel
from panelforge.spec import LI_CUTOFFS, LI_PANEL


@pytest.fixture(scope="module")
def trained(spark, sf):
    prep = P.prepare(li_panel(spark, sf), LI_PANEL, LI_CUTOFFS, P.LI_OPTS)
    own = [m for m in MD.default_registry() if m.name in ("LinearRegression", "Ridge")]
    done, failed = MD.train_all([*own, MD.ModelSpec("Broken", lambda train, label: None, False)], prep.data, LI_PANEL.target, prep.features, prep.scaled_features)
    return prep, own, done, failed


def test_trained_models_reach_the_leaderboard_with_a_score(spark, trained):
    prep, _, done, failed = trained
    assert [n for n, _ in failed] == ["Broken"] and len(done) == 2
    records = MD.metrics_records(done)
    lb = R.leaderboard(records)
    rows = lb.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert all(r.engineering_score is not None and r.val_pred_time_s > 0 and r.deployment_status for r in rows)
    # metadata go to files and come back beside the leaderboard; a model without any gets the defaults
    folder = tempfile.mkdtemp(prefix="pf-m-")
    IO.write_records(MD.metadata_records(spark, done[:1]).coalesce(1), folder)
    metadata = IO.read_json_records(spark, folder, IO.METADATA_SCHEMA, ".json", key="model_name")
    got = {r.model: r for r in R.with_metadata(lb, metadata).collect()}
    a, b = (got[d.name] for d in done)
    assert a.n_features == str(len(prep.features)) and a.training_rows == str(prep.data.where("split = 'train'").count()) and a.hyperparameters and len(a.trained_at) == 19
    assert (b.n_features, b.trained_at, b.hyperparameters) == ("N/A", "N/A", {})


def test_pipeline_is_saved_loaded_and_scores_the_same(spark, sf, trained):
    _, own, done, _ = trained
    opts = P.LI_OPTS
    panel = P.CL.drop_null_target(P.feature_panel(li_panel(spark, sf), LI_PANEL, opts, LI_CUTOFFS), LI_PANEL.target)
    split = P.I.materialize(SP.chronological_split(panel, "day", LI_CUTOFFS))
    features = [f for f in P.numeric_columns(split, {LI_PANEL.entity, *LI_PANEL.placeholders, LI_PANEL.target, "split"}) if f != "day"]
    train = split.where("split = 'train'").drop(opts.index_name)
    folder, history, latest = (tempfile.mkdtemp(prefix="pf-v-") for _ in range(3))
    fitted = {m.name: S.fit_pipeline(train, LI_PANEL, opts, m, features, history_max=Q.LI_HISTORY_MAX) for m in own}
    for model in fitted.values():
        model.save(folder)
    # the pipeline gives what the separate steps gave
    apart = {(r.entity, r.day): r.prediction for r in done[0].scored.select("entity", "day", "prediction").collect()}
    whole = fitted[done[0].name].pipeline.transform(split.drop(opts.index_name))
    assert all(abs(apart[r.entity, r.day] - r.prediction) < 1e-6 for r in whole.select("entity", "day", "prediction").collect())

    lb = R.leaderboard(MD.metrics_records(done))
    other = spark.newSession()
    loaded = S.serving_model(lb, folder, LI_PANEL, opts, any_status=True, history_max=Q.LI_HISTORY_MAX)
    assert loaded.name == lb.where("rank = 1").first().model and loaded.features == features
    if not lb.where("deployment_status = 'Production Ready'").count():
        with pytest.raises(ValueError, match="no production-ready"):
            S.serving_model(lb, folder, LI_PANEL, opts)

    req = P.I.materialize(Q.li_requests(spark, sf).where("entity < 5").withColumn("date", F.when(F.col("entity") == 4, "not a date").otherwise(F.col("date")))
                          .withColumn("channels", F.when(F.col("entity") == 3, F.map_filter("channels", lambda k, v: k != "a")).otherwise(F.col("channels"))))
    answers = P.I.materialize(loaded.score(req, ["entity"]))
    mine = fitted[loaded.name].score(req, ["entity"])
    cells = lambda df: sorted((r.entity, r.date or "", r.predicted, r.errors) for r in df.collect())
    assert str(cells(answers)) == str(cells(mine)) and answers.count() == req.count()
    bad = answers.where("errors is not null")
    assert bad.where("entity = 4 and array_contains(errors, 'date_invalid')").count() == req.where("entity = 4").count()
    assert bad.where("entity = 3 and array_contains(errors, 'missing_key:a')").count() == req.where("entity = 3").count()
    assert bad.where("entity < 3 and not array_contains(errors, 'history_length')").count() == 0 and bad.where("predicted is not null").count() == 0

    for _ in range(2):  # the second time is a replay
        S.record_predictions(spark, answers, 0, history, latest, ["entity"])
    S.record_predictions(spark, loaded.score(req.where("entity = 1"), ["entity"]), 1, history, latest, ["entity"])
    good = answers.where("predicted is not null")
    rows = BatchSink(spark, history).read()
    assert rows.where("_batch = 0").count() == good.count() > 0
    want = {r.entity: r.date for r in good.groupBy("entity").agg(F.max("date").alias("date")).collect()}
    assert {r.entity: r.date for r in KeyedTable(spark, latest, ["entity"], ["date", "predicted_at"]).read().collect()} == want
