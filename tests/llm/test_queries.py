"""Registered queries against their SQL, and the pipeline against brute force, on the smallest tables."""

import math
import os
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tachyline.llm import pieces, registry, string_tiling, toxicity
from tachyline.llm.common import materialize

SF = "/root/testdata/sf0.001"


def plain(frame):
    clean = lambda v: None if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(v) for v in row) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.sql(f"create view {table.split('.')[0]} as select * from '{SF}/{table}'")
    got, want = registry.QUERIES[name](spark, SF).toPandas(), con.sql(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_every_numbered_query_is_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 14) if not any(re.match(rf"op{n}_", x) for x in names)] == [] and "pipeline" in names


def test_pipeline_stages(spark):
    from .test_operators import brute_components

    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), name)
        kept[name] = docs
        if name == "toxicity":
            model = toxicity.fit(before, toxicity.grades(spark.read.parquet(f"{SF}/labels.parquet")))
            rejected = {r.doc_id for r in toxicity.score_toxicity(before, model).where("toxic").collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - rejected
        if name == "near_duplicates":
            groups = brute_components({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {k for _, k in groups.values()}
        if name == "decontamination":
            items = [re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (r.text or "").lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            for r in before.collect():
                own = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (r.text or "").lower())
                inside = any(any(own[i : i + len(item)] == item for i in range(len(own) - len(item) + 1)) for item in items)
                assert inside == (r.doc_id in gone)
        if name == "secrets":
            assert docs.count() == before.count() and not any(re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r.text or "") for r in docs.collect())
        if name != "tokens":
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "token_ids"]
    back = {r.doc_id: r.text for r in pieces.decode(docs.select("doc_id", "token_ids")).collect()}
    assert back == {r.doc_id: r.text for r in kept["secrets"].collect()}
    assert {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id: r.token_ids for r in docs.collect()}


def test_pipeline_on_awkward_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (3, "same words here and there again", None, None, None), (3, "same words here and there again", None, None, None), (4, "Same words here and there again", "en", "s", 1)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        if name == "near_duplicates":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 0, 1, 2, 3]
    assert docs.count() == 5
    clash = ["toxic", "severity", "grade", "key", "secret_spans", "__text_key", "tokens", "node"]
    first = spark.createDataFrame([(i, t, None, None, None, *clash) for i, t in ((1, "some words that nobody else has"), (1, "some words that nobody else has"), (1, "other words under the same identifier"))], ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"`{c}` string" for c in clash)]))
    own = first
    for name, stage in corpus_pipeline.STAGES[:-1]:
        own = materialize(stage(spark, own, SF), name)
        assert own.schema.simpleString() == first.schema.simpleString()
    assert sorted(r.text[:5] for r in own.collect()) == ["other", "some "] and all(list(r)[5:] == clash for r in own.collect())
    empty = docs.sparkSession.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, SF), name)
    assert empty.count() == 0
