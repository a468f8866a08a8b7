import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wingspan.operators import upkeep as U
from wingspan.sources.files import binary_files, parse_html_files


def test_write_verified_backup_and_export(spark):
    root = tempfile.mkdtemp(prefix="wingspan-test-")
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert U.write_verified(df, f"{root}/t", partition_by=["g"]) == 100
    assert U.write_verified(df, f"{root}/t", mode="append", partition_by=["g"]) == 100
    assert spark.read.parquet(f"{root}/t").count() == 200
    assert U.backup_if_absent(df, f"{root}/b") is True
    assert U.backup_if_absent(df, f"{root}/b") is False         # idempotent
    with pytest.raises(PermissionError):
        U.export_snapshot(df, f"{root}/e", "secret", ["id"], secured={"secret"})
    with pytest.raises(ValueError):
        U.export_snapshot(df, f"{root}/e", "t", ["g"])         # key not unique
    assert U.export_snapshot(df, f"{root}/e", "t", ["id"]) == 100
    rec = U.reconcile({"t": df}, {"t": spark.read.parquet(f"{root}/e")}).first()
    assert rec.counts_equal and rec.source_rows == 100


def test_binary_html_files(spark):
    root = tempfile.mkdtemp(prefix="wingspan-html-")
    for i in range(3):
        with open(os.path.join(root, f"m{i}.html"), "w") as f:
            f.write(f"<html><title>Manual {i}</title><body><p>TASK 29-1{i}-00 check pump</p></body></html>")
    out = parse_html_files(binary_files(spark, root, "*.html")).orderBy("file_name").collect()
    assert [r.title for r in out] == ["Manual 0", "Manual 1", "Manual 2"]
    assert all(r.parse_ok for r in out) and out[0].full_text.endswith("check pump")


def test_pipeline_runner_order_and_lineage(spark):
    from wingspan.plans.upkeep_plans import installed_base_pipeline
    p = installed_base_pipeline("/unused")
    order = p.order()
    assert order.index("silver_enriched_maintenance") < order.index("gold_customer_operations")
    assert order.index("bronze_component_telemetry") < order.index("gold_component_health")


def test_lineage_closure_with_cycles(spark):
    from wingspan.operators.security import lineage_closure
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "b"), ("a", "b"),
                                   ("x", None), (None, "y"), ("s", "s")], "source_table string, target_table string")
    got = {tuple(r) for r in lineage_closure(edges).collect()}
    assert got == {("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("b", "c", 1), ("b", "d", 2), ("b", "b", 3),
                   ("c", "d", 1), ("c", "b", 2), ("c", "c", 3), ("d", "b", 1), ("d", "c", 2), ("d", "d", 3),
                   ("s", "s", 1)}
    assert lineage_closure(edges.filter("false")).count() == 0


def test_curve_layout_skips_row_groups_on_either_column(spark):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    # one value of ``a`` holds a third of all rows; ``t`` is text with nulls
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.xxhash64("id") % 1000).cast("long").alias("a"),
        F.when(F.col("id") % 50 > 0, F.md5(F.col("id").cast("string"))).alias("t"), F.lit(1).alias("_curve"))
    path = tempfile.mkdtemp(prefix="wingspan-curve-")
    U.cluster(df, ["a", "t"], 16).write.mode("overwrite").parquet(path)
    assert spark.read.parquet(path).exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 20000
    for name, value in (("a", 900), ("t", "a0")):
        read = total = 0
        for f in glob.glob(f"{path}/*.parquet"):
            m = pq.read_metadata(f)
            at = m.schema.to_arrow_schema().names.index(name)
            for g in range(m.num_row_groups):
                st = m.row_group(g).column(at).statistics
                total += 1
                read += st.has_min_max and st.min <= value <= st.max
        assert total >= 12 and read <= total / 2, (name, read, total)


def test_curve_key_follows_each_column(spark):
    df = spark.createDataFrame([(i, float(j)) for i in range(8) for j in range(8)], "i int, j double")
    got = {(r.i, r.j): r.k for r in df.withColumn("k", U.curve_key(df, ["i", "j"], bits=3)).collect()}
    for (i, j), k in got.items():
        assert all(k <= got[(a, b)] for a, b in got if a >= i and b >= j)
    nothing = df.filter("false").union(spark.createDataFrame([(None, None)], df.schema))
    assert nothing.select(U.curve_key(nothing, ["i", "j"])).first()[0] == 0
    with pytest.raises(ValueError):
        U.curve_key(df, ["i"] * 11)
