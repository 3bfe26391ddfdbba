"""The pipeline's stages, each on its own input, and the registered queries of this folder."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    result = compare(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert result["ok"], result


def test_stages(spark):
    from test_corpus_operators import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.quality(spark, docs, SF)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == columns and {i for i, q in labels.items() if q == 1} <= kept
    assert not kept & {i for i, q in labels.items() if q == 0}
    single = corpus_pipeline.near_duplicates(spark, good, SF)
    component, _ = brute_components({r.doc_id: r.text for r in good.collect()})
    assert single.columns == columns and {r.doc_id for r in single.collect()} == set(component.values())
    clean = corpus_pipeline.personal_data(spark, single, SF)
    assert clean.columns == columns and clean.count() == single.count()
    assert not [r for r in clean.collect() if "@mail" in r.text or r.n_chars != len(r.text)]
    packed = corpus_pipeline.sequences(spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == set(component.values())


KIND = "doc_id long, text string, lang string, source string, n_chars long"


def through(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_empty_table(spark, tmp_path):
    assert through(spark, spark.createDataFrame([], KIND), tmp_path) == []


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Repeated rows, null ids and texts, and columns named like the stages' helpers."""
    good = "A quiet sentence about the garden and the river, and the people who walk there in the evening with a dog."
    rows = [(i, f"{good} Number {i} says so and nobody else does, as far as we know from {i * 7} letters.", "en", "s", 1) for i in range(30)]
    rows += [rows[3], rows[3], (None, good, None, None, None), (100, None, None, None, 0), (101, "", "en", "s", 0),
             (102, "write to someone.else@mail.example.org today, it is the right thing to do for all of us", "en", "s", 9)]
    df = spark.createDataFrame(rows, KIND)
    plain = through(spark, df, tmp_path / "plain")
    for name in ("_id", "_key", "_text", "_spans", "c0", "score", "kept", "component_id", "pattern", "node", "a"):
        df = df.withColumn(name, F.lit("x"))
    clashing = through(spark, df, tmp_path / "clashing")
    assert {r.doc_id for r in plain} == {r.doc_id for r in clashing}
    assert len({(r.sequence_id, r.offset) for r in clashing}) == len(clashing)
    ids = [r.doc_id for r in plain]
    assert ids.count(3) == 1 and {0, 29, 102, None} <= set(ids) and not {100, 101} & set(ids)
