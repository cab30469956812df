"""panelforge: Spark-native toolkit for entity x time panels.

Profiling, cleaning, window features, chronological splits, KNN imputation,
scaling, Spark ML training and metrics, composite ranking, explainability,
index bands and advisories, batch and streaming scoring -- all as
DataFrame -> DataFrame operators built from native Spark expressions.
"""

__version__ = "0.1.0"
