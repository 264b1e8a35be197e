"""The corpus pipeline, stage by stage, and the registered queries."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from demandops.llm import oracle, queries
from demandops.llm.common import bloom_build, bloom_probe, global_rank
from tests.llm.helpers import documents, odd_texts
from tests.llm.test_dedup_operators import brute_components
from tests.llm.test_native_operators import words7

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(oracle.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(oracle.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    order = lambda df: df.astype(object).where(df.notna(), None).map(repr).sort_values(list(df.columns)).reset_index(drop=True)
    fix = lambda df: df.apply(lambda c: c.astype("Int64") if c.dtype.kind in "if" and c.dropna().mod(1).eq(0).all() else c)
    pd.testing.assert_frame_equal(order(fix(got)), order(fix(want)))


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [words7(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(b[i:i + 10]) for b in bench for i in range(len(b) - 9)}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            assert set(after) <= {d for d, _ in before}
        if name == "near_duplicates":
            assert set(after) == {c for _, n, c in brute_components(before) if n} | {d for d, n, _ in brute_components(before) if not n}
        if name == "benchmark":
            bad = {d for d, t in before if any(tuple(w[i:i + 10]) in grams for w in [words7(t)] for i in range(len(w) - 9))}
            assert set(after) == {d for d, _ in before} - bad
        if name == "secrets":
            assert len(after) == len(before) and not any("token = \"" in t and "[SECRET]" not in t for t in after.values())
        docs = out
    assert docs.select("doc_id").distinct().count() == len(before)


def test_stages_on_odd_rows_and_empty_tables(spark):
    docs = documents(spark, odd_texts())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= 12 + docs.count() + 20
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_bloom_filter_never_misses(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    bloom = bloom_build(keys, ["k"], 16)   # far too small: passes more, misses none
    passed = {r["k"] for r in bloom_probe(spark.range(3000).withColumnRenamed("id", "k"), bloom, ["k"], 16).collect()}
    assert set(range(0, 3000, 3)) <= passed


def test_global_rank_is_dense_with_ties(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(500)] + [(None, 1000)], "a int, b long")
    ranks = [(r["a"], r["b"], r["r"]) for r in global_rank(df, ["a", "b"], "r", "t").collect()]
    assert sorted(r for _, _, r in ranks) == list(range(501))
    assert [x[:2] for x in sorted(ranks, key=lambda x: x[2])] == \
        sorted(((a, b) for a, b, _ in ranks), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
