"""lookup_join: broadcast behind a size check, salted shuffle join beyond it."""

from pyspark.sql import functions as F

from demandops.functions.joins import lookup_join


def test_salted_join_spreads_a_hot_key(spark):
    big = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 97).cast("string"))
         .alias("k"), F.col("id"))
    lookup = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    keys = ("demandops.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("demandops.broadcast.maxRows", "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")       # no skew splitting by AQE
        out = lookup_join(big, lookup, ["k"], "left", buckets=16)
        assert "_salt" not in out.columns
        hot = out.filter(F.col("k") == "HOT").select(F.spark_partition_id().alias("p"), "n")
        assert hot.select("p").distinct().count() > 4               # spread over several tasks
        assert hot.count() == 10000 and hot.filter(F.col("n") != 10000).count() == 0
        assert out.count() == 30000
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_lookup_is_broadcast(spark):
    big = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), "id")
    lookup = big.groupBy("k").agg(F.max("id").alias("m"))
    out = lookup_join(big, lookup, ["k"], "left")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1000


def test_a_repetitive_lookup_is_measured_by_its_rows(spark):
    """2,000,000 rows that a file holds in a few MB: the planner's estimate is
    under its threshold, the rows are not."""
    from demandops.sources.io import materialize
    from demandops.sources.tables import fits_broadcast
    lookup = materialize(spark.range(2_000_000).select(
        F.floor(F.col("id") / 4).alias("k"), F.lit("x" * 200).alias("text")), "repetitive")
    estimate = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * estimate))
        assert estimate < 40_000_000 and not fits_broadcast(lookup)
        big = spark.range(10).withColumnRenamed("id", "k")
        plain = big.join(lookup, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plain                 # what the estimate alone leads to
        plan = lookup_join(big, lookup, ["k"], "left", buckets=4)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan and "_salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_row_bytes_count_nested_values(spark):
    from demandops.sources.tables import row_bytes
    df = spark.sql("SELECT 1 AS a, 'four' AS b, array(1L, 2L, 3L) AS c UNION ALL SELECT NULL, NULL, NULL")
    got = sorted(r[0] for r in df.select(row_bytes(df)).collect())
    assert got[0] >= 8 * 4 and got[1] >= 8 * 4 + 4 + 24


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_a_large_lookup_unsorted(spark):
    """Over the broadcast bound the lookup is hashed in its shuffle partitions;
    the lines are not sorted, and the fact is the same."""
    from demandops.sources.adapter import sales_fact
    from tests.conftest import SF_SMALL
    want = sales_fact(spark, SF_SMALL)
    keys = ("demandops.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("demandops.broadcast.maxRows", "100")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sales_fact(spark, SF_SMALL)
        assert "SortMergeJoin" not in _plan_text(got) and "ShuffledHashJoin" in _plan_text(got)
        rows = sorted(map(str, got.collect()))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows == sorted(map(str, want.collect())) and len(rows) > 1000


def test_only_a_lookup_of_far_fewer_rows_is_hashed(spark):
    from demandops.sources.io import materialize
    from demandops.sources.tables import hash_side
    lookup = materialize(spark.range(1000).withColumnRenamed("id", "k"), "keys")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n, join in ((4000, "ShuffledHashJoin"), (3999, "SortMergeJoin")):
            big = materialize(spark.range(n).select((F.col("id") % 1000).alias("k"), "id"), "rows")
            out = big.join(hash_side(lookup, big), "k")
            assert join in _plan_text(out) and out.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_cents_are_summed_as_decimals_are(spark):
    from demandops.functions.numeric import exact_cents
    odd = [1.005, 0.125, 2.675, -0.005, -0.0, 0.1, 19999999.99, 2e7, 20000000.01, 12345678.901, 1e15 + 0.5, float("nan"), None]
    rows = [(0, x) for x in odd] + [(1, i / 100.0) for i in range(-500, 5000)] + [(2, None), (3, 1e15 + 0.5), (3, 0.01), (4, 0.07)]
    df = spark.createDataFrame(rows + [(k + 10, x) for k, x in enumerate(odd)], "k int, x double")
    out = df.groupBy("k").agg(exact_cents("x").alias("a"), F.sum(F.col("x").cast("decimal(18,2)")).alias("b"))
    assert out.schema["a"].dataType == out.schema["b"].dataType
    assert out.count() == 5 + len(odd)
    assert out.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_tables_in_one_folder_are_measured_apart(spark, tmp_path):
    """Tables of one file each, side by side, as the driver's are."""
    from demandops.sources.tables import fits_broadcast, read_table
    for name, n in (("small", 10), ("large", 500)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "parts" / name))
        (part,) = (tmp_path / "parts" / name).glob("*.parquet")
        part.rename(tmp_path / f"{name}.parquet")
    small, large = (read_table(spark, str(tmp_path), name) for name in ("small", "large"))
    assert fits_broadcast(small, 100) and not fits_broadcast(large, 100) and fits_broadcast(small, 100)
