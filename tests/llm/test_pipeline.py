"""The pipeline on odd documents, stage by stage, and its queries' registration."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from test_text_ops import DOCS, ODD

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = {r["item_id"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert bench and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_dedup", "decontaminate", "secret_scan", "mix_sources"]
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        assert after.columns == (names if name != "mix_sources" else [*names, "repeats"])
        if name == "language_id":
            assert after.count() == before.count()  # every real text is in a language
        if name == "simhash_dedup":
            groups = entry.queries()["op10_simhash_dedup"](spark, SF)
            assert after.count() == groups.select("component_id").distinct().count()
        if name == "decontaminate":
            dirty = entry.queries()["op4_decontaminate"](spark, SF).select("doc_id").distinct()
            assert after.join(dirty, "doc_id").count() == 0
            assert before.join(dirty, "doc_id", "left_anti").count() == after.count()
        if name == "secret_scan":
            assert after.count() == before.count()
            assert after.where("text rlike 'AKIA[A-Z0-9]{14}|[0-9a-f]{16}'").count() == 0
            assert after.where(F.col("n_chars") != F.length("text")).count() == 0
        before = after


def test_odd_documents_pass_every_stage(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumns({"score": F.lit(1), "fp": F.lit("x"), "target": F.lit(2)})
    names = docs.columns
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, SF)
            assert table.columns[:len(names)] == names
            table.count()


def test_columns_named_like_the_stages_own(spark):
    clash = ["__row", "__keep_id", "__copies", "__source", "__cut", "__take", "__c0", "mix_repeats", "Mix_Size", "repeats",
             "_repeats", "key", "cut", "take"]
    docs = spark.createDataFrame(ODD, DOCS).withColumns({c: F.lit(c) for c in clash})
    docs = docs.unionAll(docs)
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        assert after.columns == (names if name != "mix_sources" else [*names, "__repeats"])
        rows = after.collect()
        assert rows and all(r[c] == c for r in rows for c in clash)
        before = spark.createDataFrame(rows, after.schema)


def test_registered_queries_have_their_numbers():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_queries_equal_their_sql(spark):
    import duckdb
    sf, con = "/root/testdata/sf0.01", duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    from cohortlab.llm.queries import oracle_sql, registry
    for name, sql in oracle_sql().items():
        got = registry()[name](spark, sf)
        want = con.execute(sql)
        order = [d[0] for d in want.description]
        assert sorted(map(tuple, got.select(*order).collect()), key=str) == sorted(want.fetchall(), key=str), name


def test_workers_need_no_path_to_the_package(tmp_path):
    """From another folder, with the package on the driver's path alone."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from cohortlab.session import local_session
import __spark_entry__ as e
spark = local_session(2)
for name in ("op1_language_id", "op8_warc", "op7_vector_search"):
    print("rows", e.queries()[name](spark, {SF!r}).count())
import corpus_pipeline
docs = spark.read.parquet({SF!r} + "/documents.parquet")
print("rows", corpus_pipeline.STAGES[3][1](spark, docs, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.count("rows") == 4, out.stderr[-2000:]
