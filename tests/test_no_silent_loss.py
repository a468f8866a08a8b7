"""Edges at which rows used to be lost or changed without an error."""

import os

import pytest
from pyspark.sql import functions as F

from wingspan.operators import features as ft
from wingspan.operators import models as M
from wingspan.operators import replay as rp
from wingspan.operators import search as S
from wingspan.operators import security as sec
from wingspan.operators import text as T
from wingspan.operators.ordering import group_row_number
from wingspan.plans.registry import round6
from wingspan.plans.text_plans import corpus_index
from wingspan.session import ensure_checkpoint_dir, scratch_path
from wingspan.streaming import ingest


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 0), (3, "a", 1), (4, "a", None), (5, "b", None)],
                               "id long, g string, y int")
    got = sorted((r.g or "", r.rn) for r in group_row_number(df, ["g"], [F.col("id")], "rn").collect())
    assert got == [("", 1), ("", 2), ("a", 1), ("a", 2), ("b", 1)]
    assert rp.quota_sample(df, "g", "id", 1.0).count() == 5
    assert ft.stratified_folds(df, "id", "y", 2).count() == 5
    assert M.with_balanced_weights(df).count() == 5


def test_wildcard_sees_unlisted_and_null_airlines(spark):
    ents = sec.entitlements(spark, spark.createDataFrame([("AL01",)], "airline string"))
    data = spark.createDataFrame([(1, "AL01", 1.0), (2, "ZZ", 2.0), (3, None, 3.0)],
                                 "id long, airline string, money double")
    assert sec.secure(data, ents, "platform_owner", []).count() == 3
    assert [r.id for r in sec.secure(data, ents, "x", ["operator_al01"]).collect()] == [1]
    many = sec.secure_many(data, ents, [("platform_owner", []), ("x", ["operator_al01"]), ("nobody", [])],
                           masked=("money",)).collect()
    assert sorted((r.caller, r.id, r.money) for r in many) == [
        ("platform_owner", 1, 1.0), ("platform_owner", 2, 2.0), ("platform_owner", 3, 3.0), ("x", 1, None)]
    plan = sec.secure_many(data, ents, [("platform_owner", []), ("x", ["operator_al01"])])
    assert "NestedLoop" not in plan._jdf.queryExecution().toString()


def test_mask_and_filter_functions_run(spark):
    sec.entitlements(spark, spark.createDataFrame([("AL01",)], "airline string")).createOrReplaceTempView(
        "operator_entitlements")
    spark.sql(sec.ROW_FILTER_SQL)
    spark.sql(sec.COLUMN_MASK_SQL)
    r = spark.sql("""SELECT airline_row_filter('ZZ', 'x', array('field_service')) AS a,
      airline_row_filter('ZZ', 'x', array('operator_al01')) AS b,
      financial_mask(5.0D, 'platform_owner', array()) AS c, financial_mask(5.0D, 'x', array('field_service')) AS d
    """).first()
    assert tuple(r) == (True, False, 5.0, None)


def test_folder_table_streams_all_rows(spark):
    root = scratch_path(spark, "folder-table").removeprefix("file:")
    spark.range(600).selectExpr("id", "id * 2 AS v").repartition(3).write.parquet(f"{root}/events.parquet")
    stream = ingest.stream_table(spark, root, "events")
    ingest.run_to_sink(stream, f"{root}/sink", f"{root}/ck", "folder_rows")
    assert spark.read.parquet(f"{root}/sink").count() == 600


def test_index_sync_keeps_one_row_per_key_and_raises_on_a_bad_index(spark):
    root = scratch_path(spark, "sync").removeprefix("file:")
    schema = "chunk_id string, chunk string, v int"
    ingest.append_batch(spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], schema), f"{root}/src")
    stream = spark.readStream.schema(schema).parquet(f"{root}/src")
    ingest.sync_changed(stream, f"{root}/index", "chunk_id", f"{root}/ck", version="v")
    assert [(r.chunk_id, r.chunk) for r in spark.read.parquet(f"{root}/index").collect()] == [("k", "new")]
    os.makedirs(f"{root}/bad")
    with open(f"{root}/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        ingest.sync_changed(spark.readStream.schema(schema).parquet(f"{root}/src"), f"{root}/bad", "chunk_id",
                            f"{root}/ck2")
    assert os.listdir(f"{root}/bad") == ["part-0.parquet"]


def test_large_values_are_rounded_not_clamped(spark):
    vals = [2.5e13, 9.3e12, -2.5e13, 1.23456789, -1.23456749, 1e300]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r.x for r in df.select(round6(F.col("x")).alias("x")).collect()] == [
        2.5e13, 9.3e12, -2.5e13, 1.234568, -1.234567, 1e300]


def test_fusion_window_follows_k(spark):
    hits = spark.range(300).select(F.lit(0).alias("query_id"), F.col("id").alias("key"),
                                   (F.lit(1.0) / (F.col("id") + 1)).alias("score"))
    assert S.hybrid(hits, hits, 150, "key").count() == 150


def test_long_documents_do_not_share_chunk_keys(spark):
    docs = spark.createDataFrame([(0, "a\n" * 3, "en", "s"), ((1 << 62) + 1, "b\n" * 3, "en", "s")],
                                 "doc_id long, text string, lang string, source string")
    ch = T.section_chunks(docs)
    assert ch.select("chunk_key").distinct().count() == ch.count() == 6


def test_tree_draw_threshold_reaches_any_size():
    for n in (1, 10, 10**6, 8 * 10**8, 10**9, 10**13):
        t = M.draw_threshold(n, 256)
        assert t > 0 and (n <= 768 or abs(t / 2**63 * n - 768) < 1)


def test_rewritten_files_renew_the_search_index(spark):
    root = scratch_path(spark, "corpus").removeprefix("file:")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    path = f"{root}/documents.parquet"
    spark.createDataFrame([(1, "alpha beta", "en", "s", 10)], schema).write.parquet(path)
    first = corpus_index(spark, root)
    assert corpus_index(spark, root) is first
    spark.createDataFrame([(2, "gamma", "en", "s", 5)], schema).write.mode("append").parquet(path)
    assert corpus_index(spark, root).n_docs == 2


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(ensure_checkpoint_dir(spark).rstrip("/"))
