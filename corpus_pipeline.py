"""A corpus pipeline in five stages: toxicity, near duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of ``documents``; the driver writes each result as Parquet and rereads it as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tachyline.llm.common import materialize
from tachyline.llm.ngram_join import jaccard_components
from tachyline.llm.pieces import encode
from tachyline.llm.secret_scan import scan_secrets
from tachyline.llm.string_tiling import contamination, text_key
from tachyline.llm.toxicity import fit, grades, score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but doc_id and text under names that no operator uses, and what selects them back."""
    held = {c: f"__{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(held), [F.col(held.get(c, c)).alias(c) for c in docs.columns]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with P(grade > 0) of 0.5 or more go."""
    model = fit(docs, grades(_table(spark, sf_dir, "labels")))
    own, columns = _aside(docs)
    return score_toxicity(own, model).where("not toxic").select(columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component at Jaccard 0.75 on five-word shingles the smallest doc_id stays. Of rows that repeat doc_id and
    text one stays, the first by its other columns as JSON; different texts of one doc_id all stay. Rows without doc_id
    link with nothing and stay."""
    found = jaccard_components(docs)
    gone = materialize(found.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    again = materialize(found.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    kept = docs.join(gone, "doc_id", "left_anti")
    once = kept.join(again, "doc_id", "left_anti")
    more = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("__"))
    repeated = kept.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min_by(more, F.to_json(more)).alias("__more")).select("doc_id", "text", "__more.*")
    return once.select(docs.columns).unionByName(repeated.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover 0.6 of a benchmark item go."""
    found = contamination(docs, _table(spark, sf_dir, "benchmark")).select(F.col("key").alias("__text_key"))
    own, columns = _aside(docs)
    return own.withColumn("__text_key", text_key()).join(found, "__text_key", "left_anti").select(columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; all documents stay."""
    own, columns = _aside(docs)
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        columns[at] = F.when(F.size("secret_spans") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"__{at}")).alias("n_chars")
    return scan_secrets(own, redact=True).select(columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids."""
    return encode(docs.select("doc_id", "text"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("tokens", tokens)]

#: The stages fit a model and follow links, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and reread."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
