"""Lifecycle 3.3 for a *table* of requests (SRV-01..03, PRJ-09, IMP-03, SCL-02, FN-16).

A request carries today's channel readings (map), the previous 7 target values
(oldest first) and previous channel readings (map ``<channel>_lag_<k>``). The
inference vector is rebuilt with the same names as the training features,
validated, imputed with the fitted imputer, scaled with the fitted parameters
and scored; predictions are rounded half-even, clipped, banded and given the
category's advisories. The same function runs in batch and inside
``foreachBatch`` of a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import bands as B
from ..functions import calendar as C
from ..functions import index as IDX
from ..operators import clean as CL
from ..operators import scale as SC
from ..operators import rank as R
from ..operators import validate as V
from ..operators.models import ModelSpec, assemble
from ..operators.stages import PanelImputer, PanelIndex, PanelScaler
from ..spec import PanelSpec
from ..sources.sinks import BatchSink, KeyedTable
from .prepare import FeatureOptions, Prepared


@dataclass
class ServingArtefacts:
    spec: PanelSpec
    opts: FeatureOptions
    prepared: Prepared
    model: object
    uses_scaled: bool
    model_name: str
    clip: tuple[int, int] = (0, 500)
    history_max: float = V.HISTORY_MAX

    @property
    def features(self) -> list[str]:
        return self.prepared.features

    @property
    def index_bounds(self) -> dict:
        return self.prepared.index_bounds


def inference_vector(req: DataFrame, art: ServingArtefacts | ServingModel) -> DataFrame:
    """PRJ-09: request -> the training feature columns (absent ones NULL, PRJ-05)."""
    spec, opts = art.spec, art.opts
    d = C.parse_date("date")
    ch = F.col("channels")
    lags = F.col("channel_lags")
    hist = F.col("target_history")
    cols = {
        "Year": F.year(d), "Month": F.month(d), "DayOfMonth": F.dayofmonth(d), "DayOfWeek": F.weekday(d),
        "IsWeekend": F.coalesce((F.weekday(d) >= 5).cast("int"), F.lit(0)),
    }
    if opts.period:
        cols["in_period"] = F.coalesce(d.between(F.lit(opts.period[0]).cast("date"),
                                                 F.lit(opts.period[1]).cast("date")), F.lit(False)).cast("int")
    for c in spec.channels:
        cols[c] = F.try_element_at(ch, F.lit(c))
    t = spec.target
    for k in opts.target_lags:
        cols[f"{t}_lag_{k}"] = A.from_end(hist, k)
    cols.update(A.history_features(hist, prefix=t))
    for c, ks in opts.channel_lags.items():
        for k in ks:
            cols[f"{c}_lag_{k}"] = F.try_element_at(lags, F.lit(f"{c}_lag_{k}"))
    for c in opts.change_cols:
        cols[f"{c}_change"] = F.try_element_at(ch, F.lit(c)) - F.try_element_at(lags, F.lit(f"{c}_lag_1"))
    out = req.select("*", *[v.alias(k) for k, v in cols.items()])
    ms, mc = C.cyclical("Month", 12)
    ds, dc = C.cyclical("DayOfWeek", 7)
    out = out.withColumns({"Month_sin": ms, "Month_cos": mc, "DayOfWeek_sin": ds, "DayOfWeek_cos": dc})
    if spec.index_weights and art.index_bounds:
        out = out.withColumn(opts.index_name, IDX.index_expr(dict(spec.index_weights), art.index_bounds))
    keep = [c for c in req.columns]
    return CL.reindex(out, [(c, out.schema[c].dataType.simpleString()) for c in keep] +
                      [(c, "double") for c in art.features])


def check_requests(req: DataFrame, art: ServingArtefacts | ServingModel) -> DataFrame:
    """VAL-07 on every request: ``errors`` lists the failed rules (all channels required, their lags not negative)."""
    lags = {f"{c}_lag_{k}": F.try_element_at("channel_lags", F.lit(f"{c}_lag_{k}")) for c, ks in art.opts.channel_lags.items() for k in ks}
    errs = V.request_errors(F.col("entity").cast("string"), F.col("date"), F.col("channels"), art.spec.channels,
                            F.col("target_history"), lags, hist_max=art.history_max)
    return req.withColumn("errors", errs)


def _answers(scored: DataFrame, checked: DataFrame, key: list[str], clip: tuple[int, int], name: str) -> DataFrame:
    """FN-16 and after: rounded and clipped predictions with category, advisories, model and time; invalid requests with their errors."""
    lo, hi = clip
    pred = F.least(F.lit(hi), F.greatest(F.lit(lo), F.bround("prediction", 0).cast("int")))  # FN-16
    out = scored.select(*key, "date", pred.alias("predicted"), F.col("prediction").alias("raw_prediction"))
    out = out.withColumn("category", B.category("predicted"))
    out = out.withColumn("advisories", B.advisories("category"))
    out = out.withColumn("model_used", F.lit(name)).withColumn("predicted_at", F.current_timestamp())  # FN-25
    bad = checked.where(F.size("errors") > 0).select(*key, "date", "errors")
    return out.unionByName(bad, allowMissingColumns=True)


def score_requests(req: DataFrame, art: ServingArtefacts, key: list[str]) -> DataFrame:
    """SRV-01: validate -> vector -> impute -> scale -> predict -> round/clip -> band -> advise.
    Invalid requests are returned with their errors and no prediction."""
    spec, prep = art.spec, art.prepared
    checked = check_requests(req, art)
    vec = inference_vector(checked, art).withColumn(spec.time, C.parse_date("date"))
    if prep.knn is not None:
        vec = prep.knn.transform(vec)  # IMP-03: fitted donors
    else:
        means = prep.data.where("split = 'train'").agg(*[F.avg(c).alias(c) for c in prep.features]).first()
        vec = vec.fillna({c: means[c] for c in prep.features if means[c] is not None})
    vec = SC.apply_scaler(vec, prep.scaler, suffix=prep.suffix)  # SCL-02
    feats = prep.scaled_features if art.uses_scaled else prep.features
    scored = art.model.transform(assemble(vec.where(F.size("errors") == 0), feats))
    return _answers(scored, checked, key, art.clip, art.model_name)


# ---------------------------------------------------------------------------
# One pipeline for training and serving
# ---------------------------------------------------------------------------

@dataclass
class ServingModel:
    """A fitted pipeline (index, imputer, scaler, vector, regression) with what a request needs to become its input."""

    spec: PanelSpec
    opts: FeatureOptions
    pipeline: PipelineModel
    name: str
    features: list[str]
    clip: tuple[int, int] = (0, 500)
    history_max: float = V.HISTORY_MAX
    index_bounds = None  # the index is a stage of the pipeline

    def score(self, req: DataFrame, key: list[str]) -> DataFrame:
        """SRV-01 with the loaded pipeline; invalid requests come back with their errors and no prediction."""
        checked = check_requests(req, self)
        vec = inference_vector(checked, self).withColumn(self.spec.time, C.parse_date("date"))
        return _answers(self.pipeline.transform(vec.where(F.size("errors") == 0)), checked, key, self.clip, self.name)

    def save(self, folder: str) -> None:
        self.pipeline.write().overwrite().save(f"{folder}/{self.name}")

    @classmethod
    def load(cls, folder: str, name: str, spec: PanelSpec, opts: FeatureOptions, **more) -> ServingModel:
        """SRV-02: the model of that name, in any session."""
        pipeline = PipelineModel.load(f"{folder}/{name}")
        imputer = next(s for s in pipeline.stages if hasattr(s, "knn"))
        return cls(spec, opts, pipeline, name, imputer.knn.cols, **more)


def fit_pipeline(train: DataFrame, spec: PanelSpec, opts: FeatureOptions, model: ModelSpec, features: list[str],
                 no_scale=("IsWeekend", "in_period", "Year"), k: int = 5, **more) -> ServingModel:
    """Fit every stage on the training rows of the feature panel (features not yet imputed; the index is made here)."""
    scaled = [c for c in features if c not in no_scale]
    inputs = [f"{c}_s" if c in scaled else c for c in features] if model.uses_scaled else features
    stages = [PanelIndex(dict(spec.index_weights), opts.index_name)] if spec.index_weights else []
    stages += [PanelImputer([spec.entity, spec.time], features, k), PanelScaler(scaled), VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]
    stages.append(model.factory(train, spec.target).setFeaturesCol("features").setLabelCol(spec.target).setPredictionCol("prediction"))
    return ServingModel(spec, opts, Pipeline(stages=stages).fit(train), model.name, list(features), **more)


def serving_model(leaderboard: DataFrame, folder: str, spec: PanelSpec, opts: FeatureOptions, any_status: bool = False, **more) -> ServingModel:
    """SRV-02: the best production-ready model of the leaderboard (``any_status``: the best one), loaded."""
    best = (R.select_best(leaderboard) if any_status else R.select_production(leaderboard)).first()
    return ServingModel.load(folder, best["model"], spec, opts, **more)


def record_predictions(spark: SparkSession, answers: DataFrame, batch_id: int, history: str, latest: str, key: list[str]) -> None:
    """SNK-08 / SNK-09 / SRV-03: predictions go to the history once per batch id, and to the latest table by key."""
    good = answers.where("predicted IS NOT NULL").select(*key, "date", "predicted", "category", "model_used", "predicted_at")
    sink = BatchSink(spark, history)
    sink.write(good, batch_id)
    # from the history as written, so that both have the same rows; merging them again changes nothing
    KeyedTable(spark, latest, key, ["date", "predicted_at"]).upsert(sink.read().where(F.col("_batch") == batch_id).drop("_batch"))
