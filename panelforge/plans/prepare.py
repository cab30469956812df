"""Lifecycle 3.1 as one plan: panel -> clean -> calendar/window features -> split ->
KNN imputation -> scaling (fit on train only).

The feature frame is materialised once (it feeds the imputer's donors, the
receivers and the reports) and the imputed frame once more; everything else is
lazy. All column names come from the PanelSpec and the options.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as C
from ..functions import index as IDX
from ..operators import clean as CL
from ..operators import impute as I
from ..operators import scale as SC
from ..operators import split as SP
from ..operators import validate as V
from ..operators import windows as W
from ..operators.ledger import Ledger
from ..spec import PanelSpec

NON_FEATURE = ("split",)


@dataclass
class FeatureOptions:
    target_lags: tuple[int, ...] = (1, 2, 3, 7)
    channel_lags: dict[str, list[int]] = field(default_factory=dict)
    change_cols: list[str] = field(default_factory=list)
    include_target_delta: bool = False  # Q1: the target delta leaks the target
    period: tuple[str, str] | None = None
    index_name: str = "pollution_index"
    index_bounds_from: str = "train"  # Q2: "all" = whole table (parity), "train" = no look-ahead
    chunk_days: int | None = 90


@dataclass
class Prepared:
    data: DataFrame  # split column, imputed features, scaled copies with suffix
    features: list[str]  # model input, unscaled
    scaled_features: list[str]  # model input for scaled-input models
    imputed: list[str]
    scaled: list[str]
    knn: I.KnnModel | None
    scaler: dict
    index_bounds: dict
    suffix: str = "_s"


def feature_panel(panel: DataFrame, spec: PanelSpec, opts: FeatureOptions,
                  cutoffs: tuple[str, str, str] | None = None) -> DataFrame:
    """Calendar, season, period flag, cyclical encodings, lags / rolling / deltas, composite
    index and placeholders -- one window pass for all window features."""
    t = spec.time
    df = CL.nan_to_null(panel)
    df = df.select(
        "*",
        F.year(t).alias("Year"), F.month(t).alias("Month"), F.dayofmonth(t).alias("DayOfMonth"),
        F.weekday(t).alias("DayOfWeek"),
        F.coalesce((F.weekday(t) >= 5).cast("int"), F.lit(0)).alias("IsWeekend"),
    )
    df = df.withColumn("Season", C.season_expr("Month"))
    if opts.period:
        df = df.withColumn("in_period", C.period_flag(t, *opts.period))
    df = C.add_cyclical(df, "Month", "DayOfWeek")
    deltas = list(opts.change_cols) + ([spec.target] if opts.include_target_delta else [])
    feats = W.standard_features(spec.target, opts.channel_lags, deltas, opts.target_lags)
    df = W.add_window_features(df, spec.entity, spec.order_cols, feats)
    weights = dict(spec.index_weights)
    if weights:
        src = df
        if opts.index_bounds_from == "train" and cutoffs:
            src = df.where(F.col(t) <= F.lit(cutoffs[0]).cast("date"))
        bounds = IDX.fit_index_bounds(src, weights)
        df = df.withColumn(opts.index_name, IDX.index_expr(weights, bounds))
    return CL.add_placeholders(df, spec.placeholders)


def numeric_columns(df: DataFrame, exclude) -> list[str]:
    """PRJ-03: numeric columns of the schema minus ``exclude`` (schema only, no scan)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def prepare(panel: DataFrame, spec: PanelSpec, cutoffs: tuple[str, str, str], opts: FeatureOptions | None = None,
            k: int = 5, no_scale=("IsWeekend", "in_period", "Year"), suffix: str = "_s",
            impute: str = "knn", ledger: Ledger | None = None) -> Prepared:
    """``impute="knn"`` is the pipeline's KNN imputation; ``impute="ffill"`` fills each
    series forward then backward (POL-01) and falls back to the training mean.
    With a ``ledger`` the panel, the features, the split and the imputed table are written as its stages."""
    opts = opts or FeatureOptions()
    V.require_columns(panel, [spec.entity, spec.time, spec.target, *spec.channels])  # VAL-01
    V.require_date_type(panel, spec.time)  # VAL-03
    if ledger:
        panel = ledger.run("load", panel)
    feats = feature_panel(panel, spec, opts, cutoffs)
    if ledger:
        feats = ledger.run("features", feats)
    feats = CL.drop_null_target(feats, spec.target)  # FLT-01
    split = SP.chronological_split(feats, spec.time, cutoffs)  # SET-04
    split = ledger.run("split", split) if ledger else I.materialize(split)
    SP.check_splits(SP.split_counts(split))  # VAL-13
    exclude = {spec.entity, *spec.placeholders, spec.target, *NON_FEATURE}
    imp_cols = [c for c in numeric_columns(split, exclude) if c not in (spec.time,)]
    train = split.where("split = 'train'")
    if impute == "knn":
        knn = I.fit_knn(train, [spec.entity, spec.time], imp_cols, k=k)  # IMP-01 fit
        filled = knn.transform(split)  # IMP-01/02 apply
    else:
        knn = None
        means = train.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in imp_cols]).first()
        # each split on its own: no value of a later split reaches an earlier one
        parts = [I.ffill_bfill(split.where(F.col("split") == name), spec.entity, spec.order_cols, imp_cols, opts.chunk_days or 90)
                 for name in SP.SPLITS]
        filled = parts[0].unionByName(parts[1]).unionByName(parts[2])
        filled = filled.fillna({c: means[c] for c in imp_cols if means[c] is not None})
    imputed = ledger.run("impute", filled) if ledger else I.materialize(filled)
    scale_cols = [c for c in imp_cols if c not in set(no_scale)]  # PRJ-04
    params = SC.fit_scaler(imputed.where("split = 'train'"), scale_cols)  # SCL-01
    data = SC.apply_scaler(imputed, params, suffix=suffix)
    features = imp_cols
    scaled_features = [f"{c}{suffix}" if c in params else c for c in imp_cols]
    return Prepared(data, features, scaled_features, imp_cols, scale_cols, knn, params,
                    IDX.fit_index_bounds(train, dict(spec.index_weights)) if spec.index_weights else {}, suffix)


# ---------------------------------------------------------------------------
# The LI preset used by the catalogue
# ---------------------------------------------------------------------------

LI_OPTS = FeatureOptions(
    channel_lags={"a": [1, 3], "n": [1], "r": [1]},
    change_cols=["a", "n"],
    period=("1998-03-01", "1998-07-31"),
)

_MEMO: dict = {}


def prepared_li(spark, sf_dir: str, impute: str = "knn") -> Prepared:
    """Prepared LI panel, materialised once per session, scale and imputation mode."""
    from ..sources.tables import li_panel
    from ..spec import LI_CUTOFFS, LI_PANEL

    key = (id(spark), sf_dir, impute)
    hit = _MEMO.get(key)
    if hit is not None:
        try:
            hit.data.limit(1).count()
            return hit
        except Exception:
            _MEMO.pop(key, None)
    out = prepare(li_panel(spark, sf_dir), LI_PANEL, LI_CUTOFFS, LI_OPTS, impute=impute)
    _MEMO[key] = out
    return out
