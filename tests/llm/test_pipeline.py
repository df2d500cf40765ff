import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, "/root/repo")
import corpus_pipeline  # noqa: E402
from marketframe.llm import decontam, packing, pii, quality, simhash  # noqa: E402
from marketframe.llm.queries import ORACLES, QUERIES  # noqa: E402

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_stages_pass_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    left = {docs.count()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF01)
        if k == len(corpus_pipeline.STAGES) - 1:
            break
        out = out.checkpoint()
        assert out.dtypes == docs.dtypes
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if k == 0:
            want = {r.doc_id for r in quality.classified(docs).where("kept").collect()}
        elif k == 1:
            want = {r.component_id for r in simhash.duplicate_groups(docs).collect()}
        elif k == 2:
            bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
            want = {r.doc_id for r in decontam.report(docs, bench).where("not contaminated").collect()}
        else:
            want = {r.doc_id for r in docs.collect()}
            assert not [r for r in out.collect() if pii.base_spans(r.text)]
        assert ids == want
        docs = out
        left.add(out.count())
    pieces = out.collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(left) == 4
    assert len({r.sequence_id for r in pieces}) <= -(-sum(r.length for r in pieces) // 2048) + 2


def test_whole_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF001).count()
    assert rows >= 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_duplicates", "decontamination", "personal_data", "best_fit"]


@pytest.mark.parametrize("k", range(4))
def test_stages_take_odd_and_empty_tables(spark, odd, empty, k):
    stage = corpus_pipeline.STAGES[k][1]
    clash = odd.withColumn("score", F.lit(1)).withColumn("kept", F.lit(True)).withColumn("fp", F.lit("x")).withColumn("bench_hit", F.lit(0))
    out = stage(spark, clash, SF001)
    assert out.columns == clash.columns and 0 < out.count() <= clash.count()
    assert stage(spark, empty, SF001).count() == 0


def test_packing_stage_takes_odd_rows(spark, odd):
    assert packing.packed(odd).count() >= odd.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    cur = con.execute(ORACLES[name])
    names, want = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in QUERIES[name](spark, SF001).select(*names).collect()]  # rows as they are: nulls beside integers
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
