"""Benchmark the headline stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages mirror the reference's three timed batch scripts plus a raw-lineitem
window run; every query is fully executed into Spark's ``noop`` sink (no
collect). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from panelforge.functions import calendar as C  # noqa: E402
from panelforge.operators import clean as CL  # noqa: E402
from panelforge.operators import scale as SC  # noqa: E402
from panelforge.operators import split as SP  # noqa: E402
from panelforge.plans import catalog  # noqa: E402
from panelforge.plans.prepare import LI_OPTS, feature_panel, prepare  # noqa: E402
from panelforge.session import build_session, checkpoint_dir  # noqa: E402
from panelforge.sources.tables import li_panel  # noqa: E402
from panelforge.spec import LI_CUTOFFS, LI_PANEL  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", max(CPUS, 8), app="panelforge-bench")
    if checkpoint_dir(spark) is None:
        import tempfile

        checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="pf-bench-"))
    q = catalog.queries()

    def preprocess():
        p = CL.remove_exact_duplicates(li_panel(spark, SF_DIR))
        return C.add_calendar(p, "day", period=LI_OPTS.period,
                              names=("Year", "Month", "DayOfMonth", "DayOfWeek", "IsWeekend"))

    def features():
        return feature_panel(li_panel(spark, SF_DIR), LI_PANEL, LI_OPTS, LI_CUTOFFS)

    def split_scale():
        p = SP.chronological_split(li_panel(spark, SF_DIR), "day", LI_CUTOFFS)
        params = SC.fit_scaler(p.where("split = 'train'"), ["a", "n", "r", "q"])
        return SC.apply_scaler(p, params, suffix="_s")

    stages = {
        "preprocess": preprocess,
        "features": features,
        "split_scale": split_scale,
        "knn_impute": lambda: q["knn_impute"](spark, SF_DIR),
        "prepare_pipeline": lambda: prepare(li_panel(spark, SF_DIR), LI_PANEL, LI_CUTOFFS, LI_OPTS).data,
        "raw_lineitem_windows": lambda: q["raw_lineitem_windows"](spark, SF_DIR),
        "feature_block": lambda: q["feature_block"](spark, SF_DIR),
        "profile_distribution": lambda: q["distribution"](spark, SF_DIR),
        "iqr_outliers": lambda: q["iqr_outliers"](spark, SF_DIR),
        "missing_by_split": lambda: q["missing_by_split"](spark, SF_DIR),
        "tiers_and_flags": lambda: q["tiers_and_flags"](spark, SF_DIR),
        "importance_share": lambda: q["importance_share"](spark, SF_DIR),
        "station_rows": lambda: q["station_rows"](spark, SF_DIR),
    }
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    times = {}
    run(spark.range(10).withColumn("x", F.col("id") * 2))  # JVM / codegen warm-up, not timed
    for name, build in stages.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        run(build())
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_elapsed", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf, "cpus": CPUS, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))


if __name__ == "__main__":
    main()
