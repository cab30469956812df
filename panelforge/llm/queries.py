"""The registered queries of the operators: production parameters, whole tables.

Each query gets its rows from its operator; digests are derived here.
``ORACLE`` has the DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotrain, decontam, exact_dedup, fim, html_extract, importance, langid, line_dedup, ngram_join, packing, pii, quality_rules, toxicity
from .common import crc_mod, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_deleted").cast("bigint").alias("n_deleted"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"), "text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    out = toxicity.tag(docs, toxicity.fit(docs, learn), drop=("text",))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("spans").cast("bigint").alias("n_spans"), F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("spans"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = docs.where(crc_mod("doc_id", 3) != 1)
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(learn), drop=("text",))
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels whose crc32(doc_id as text) mod 5 is not 0; the others show its accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    learn = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    out = cotrain.score(docs, cotrain.fit(docs, learn), drop=("text",))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "p_text", "p_meta", "quality", "kept")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules.apply_rules(docs)
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs)
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("bigint")
    base = F.filter("pii", lambda x: x["kind"] != "iban")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("pii")).alias("spans"),
        count("iban").alias("n_iban"),
        # what the words before a span say for or against it
        F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",").alias("scores"),
        F.coalesce(F.array_max(F.transform("pii", lambda x: x["score"])), F.lit(0.0)).alias("risk"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), drop=("text",))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", spans.alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs).drop("ids")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark").select("text"), drop=("text",))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


_EXACT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

_FIM_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
e AS (SELECT *, len(u) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS r FROM d),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
p AS (SELECT *, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1:b], '') AS y, array_to_string(u[b + 1:], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_html": op10_html,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_importance": op12_importance,
    "op13_fim": op13_fim,
}
ORACLE: dict[str, str] = {"op11_exact_dedup": _EXACT_SQL, "op13_fim": _FIM_SQL}
