"""Stages of the pipeline on given documents; SQL twins of the registered queries."""

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from oracle import connect, differences
from riskframe.llm import queries


@pytest.fixture(scope="module")
def written(spark, sf_small, awkward, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_small).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_keep_the_columns_and_take_effect(written):
    for name, before, after in written[:-1]:
        assert after.columns == before.columns, name
    quality, dedup, clean, mixed, tokens = (x[2] for x in written)
    assert quality.count() < written[0][1].count()
    assert dedup.select("text").distinct().count() == dedup.count()
    assert dedup.join(quality, "doc_id", "left_anti").isEmpty()
    assert clean.join(dedup, "doc_id", "left_anti").isEmpty()
    assert tokens.count() == mixed.count()


def test_run_equals_the_stages(spark, sf_small, written):
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    again = sorted(map(tuple, corpus_pipeline.run(spark, sf_small).select(columns).collect()))
    assert again == sorted(map(tuple, written[-1][2].select(columns).collect()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_small, awkward, name):
    assert differences(queries.QUERIES[name](spark, sf_small), connect(sf_small), queries.SQL[name]) == []


def test_near_dedup_keeps_one_row_of_each_class(spark, sf_small):
    text = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcde"}
    near = text["a"].replace("a29", "other")
    rows = [
        (None, text["a"], "y"), (None, text["a"], "x"), (None, near, "x"), (None, text["b"], "x"), (None, text["c"], "x"),
        (1, text["d"], "x"), (1, text["e"], "x"), (1, text["e"], "x"), (0, text["d"], "x"), (None, text["d"], "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, sf_small).collect()]
    of_a = [r for r in got if r[1] in (text["a"], near)]
    assert of_a in ([(None, text["a"], "x")], [(None, near, "x")])
    rest = [(None, text["b"], "x"), (None, text["c"], "x"), (0, text["d"], "x"), (1, text["e"], "x")]
    assert sorted((r for r in got if r not in of_a), key=lambda r: r[1]) == rest


def test_awkward_documents_pass_every_stage(spark, awkward, sf_small, tmp_path):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))


def test_columns_of_any_name_pass_unchanged(spark, awkward, sf_small, tmp_path):
    names = ["_size", "_part", "_i", "_d", "_n", "_s", "_taken", "_copies", "_nth", "_whole", "_node", "_lang", "_row", "row", "root", "key", "size", "target", "kept", "_D"]
    docs = awkward.drop("n_chars")
    for i, c in enumerate(names[:-1]):
        docs = docs.withColumn(c, F.concat(F.lit(f"{i} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    before = {r.doc_id: tuple(r[c] for c in names[:-1]) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        for r in spark.read.parquet(str(tmp_path / name)).collect():
            assert tuple(r[c] for c in names[:-1]) == before[r.doc_id], name


def test_mix_of_equal_ids_is_repeatable(spark, sf_small):
    rows = [(1, f"{a} two three", s) for a in "abcdefgh" for s in ("x", None)] + [(None, f"n{i} m", "y") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = sorted(map(str, corpus_pipeline.mix(spark, docs.repartition(5), sf_small).collect()))
    assert one == sorted(map(str, corpus_pipeline.mix(spark, docs.orderBy(F.desc("text")).repartition(3), sf_small).collect()))
