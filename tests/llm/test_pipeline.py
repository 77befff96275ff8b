"""The pipeline on the smallest tables against its stages done by hand."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glossaflow.llm import bpe, lines, neardup, oracles, queries


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_only_take_away(steps):
    for before, after in zip(steps[:4], steps[1:5], strict=True):
        assert after.columns == before.columns and after.count() <= before.count()
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert steps[4].count() == steps[5].count() > 0


def test_clean_documents_stay(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lost = steps[0].join(labels.where("quality = 1"), "doc_id").join(steps[1], "doc_id", "left_anti").count()
    assert lost == 0
    kept = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    for r in steps[1].collect():
        if r["doc_id"] in kept:
            assert set(kept[r["doc_id"]].split("\n")) <= set(r["text"].split("\n"))


def test_one_of_each_group_stays(steps):
    groups = neardup.near_duplicates(steps[2], percent=80).collect()  # as the stage has it
    assert {r["doc_id"] for r in steps[3].collect()} == {r["component_id"] for r in groups}


def test_run_equals_the_stages(spark, sf_dir, steps):
    ours = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert ours == sorted((r["doc_id"], r["ids_sha256"]) for r in steps[5].collect())


def test_ids_decode_to_the_texts(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    encoding = bpe.load_encoding(bpe.default_path(), bpe.default_pattern())
    for r in steps[5].collect():
        ids = memoryview(bytes(r["ids"])).cast("I").tolist()
        assert len(ids) == r["n_tokens"] and encoding.decode(ids) == texts[r["doc_id"]]


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    frame = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    ours = sorted((tuple(tidy(r[c]) for c in columns) for r in frame.collect()), key=str)
    found = con.execute(oracles.ORACLES[name])
    names = [d[0] for d in found.description]
    assert ours == sorted((tuple(tidy(x[names.index(c)]) for c in columns) for x in found.fetchall()), key=str)


def test_empty_documents_pass_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_odd_documents_pass_through(spark, sf_dir, frame, odd_texts):
    docs = frame(odd_texts)
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        after.count()
    assert lines.dedup_lines(docs).count() == len(odd_texts) and neardup.keep_one(docs).where(F.col("text").isNull()).count() == 1
