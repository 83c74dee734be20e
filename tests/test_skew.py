from pyspark.sql import functions as F

from gridlore.operators.skew import Limits, fits_broadcast, hot_keys, lookup, salted_join
from gridlore.operators.tokens import repeat_many


def skewed(spark):
    """1,200 rows: 401 with key 1, 400 without a key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(1200).select(key.cast("long").alias("k"), F.col("id").alias("a"))


def other(spark):
    return spark.range(0, 600, 2).union(spark.range(1, 2)).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("b")
    )


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_hot_keys_are_few_and_sliced_by_share(spark):
    found = hot_keys(skewed(spark), None, ["k"], Limits(parts=30, min_rows=2)).collect()
    assert [tuple(r) for r in found] == [(1, 16, 1)]
    assert hot_keys(skewed(spark), None, ["k"], Limits(parts=30, min_rows=402)).count() == 0


def of_keys(spark, counts):
    """Rows ``(k, a)``, for each key as many as ``counts`` says."""
    sizes = spark.createDataFrame(list(counts.items()), "k long, n long")
    return sizes.select("k", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("a"))


def test_slices_follow_the_work_of_both_sides(spark):
    limits = Limits(parts=16, min_rows=100)
    # Key 1 makes as many pairs as rows of key 2 are read; keys 3 and up are small.
    small = {k: 4 for k in range(3, 60)}
    left = of_keys(spark, {1: 300, 2: 90_000, **small})
    right = of_keys(spark, {1: 300, 2: 1, **small})
    found = {r.k: r for r in hot_keys(left, right, ["k"], limits, cut_right=True).collect()}
    assert set(found) == {1, 2}
    assert (found[1].left_slices, found[1].right_slices) == (2, 3)
    assert (found[2].left_slices, found[2].right_slices) == (11, 1)
    only_left = {r.k: r for r in hot_keys(left, right, ["k"], limits).collect()}
    assert (only_left[1].left_slices, only_left[1].right_slices) == (6, 1)
    # No more slices than a side has rows.
    one = hot_keys(of_keys(spark, {1: 1}), of_keys(spark, {1: 500}), ["k"], limits, cut_right=True)
    assert [tuple(r) for r in one.collect()] == [(1, 1, 11)]


def test_a_key_dense_on_both_sides_is_shared_out(spark):
    # 3,000 x 3,000 rows of one key make 9,000,000 pairs, from far fewer than 100,000 rows.
    rest = {k: 1 for k in range(2, 3000)}
    left, right = of_keys(spark, {1: 3000, **rest}), of_keys(spark, {1: 3000, **rest})
    right = right.withColumnRenamed("a", "b")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    try:
        joined = salted_join(left, right, ["k"], hint="merge", limits=Limits(min_rows=100_000))
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sum(sizes) == 3000 * 3000 + len(rest)
    assert max(sizes) < 3000 * 3000 / 8


def test_joins_equal_ordinary_joins(spark):
    left, right = skewed(spark), other(spark)
    limits = Limits(parts=30, min_rows=2)
    for how in ("inner", "left", "left_semi"):
        assert rows(salted_join(left, right, ["k"], how, limits=limits)) == rows(
            left.join(right, "k", how)
        )
    both_hot = right.union(spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("b")))
    assert rows(salted_join(left, both_hot, ["k"], limits=limits)) == rows(left.join(both_hot, "k"))


def test_condition(spark):
    left, right = skewed(spark), other(spark)
    condition = F.col("a") > F.col("b")
    for how in ("inner", "left_semi"):
        found = salted_join(left, right, ["k"], how, condition, Limits(parts=30, min_rows=2))
        plain = left.join(right, "k").where(condition)
        if how == "left_semi":
            plain = plain.select("k", "a").distinct()
        assert rows(found) == rows(plain)


def test_hot_key_and_missing_keys_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        limits = Limits(parts=64, min_rows=2)
        joined = salted_join(skewed(spark), other(spark), ["k"], "left", limits=limits)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sum(sizes) == 1200
    assert max(sizes) < 300


def test_lookup_by_size(spark, plan):
    facts, table = skewed(spark), spark.range(1200).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("b")
    )
    assert fits_broadcast(table)
    assert not fits_broadcast(table, Limits(max_rows=1199))
    assert not fits_broadcast(table, Limits(max_bytes=20_000))
    large = lookup(facts, table, ["k"], Limits(max_rows=10, parts=30, min_rows=2))
    plain = facts.join(table, "k", "left")
    assert rows(large) == rows(lookup(facts, table, ["k"])) == rows(plain)


def test_many_copies_are_shared_out(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10)], "id string, n long")
    repeated = repeat_many(groups.withColumn("copies", F.col("n")), "copies", chunk=10)
    assert rows(repeated.groupBy("id", "n").count()) == [(1, "a", 1), (10, "c", 10), (25, "b", 25)]


def test_semi_join_with_a_hot_right_key(spark):
    left = spark.range(200).select((F.col("id") % 4).alias("k"), F.col("id").alias("a"))
    right = spark.range(3000).select(
        F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("b")
    )
    limits, condition = Limits(parts=30, min_rows=2), F.col("b") % 7 == F.col("a") % 7
    found = salted_join(left, right, ["k"], "left_semi", condition, limits, repeats=True)
    assert rows(found.distinct()) == rows(left.where("k = 1"))
    assert "_salt_right" in found._jdf.queryExecution().analyzed().toString()


def test_a_table_measured_too_large_is_not_broadcast(spark, plan):
    table = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("b"))
    facts = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("a"))
    assert "BroadcastHashJoin" in plan(lookup(facts, table, ["k"]))
    assert "BroadcastHashJoin" not in plan(lookup(facts, table, ["k"], Limits(max_rows=10)))


def test_all_kinds_of_columns_are_measured(spark):
    wide = spark.range(10).select(F.array_repeat(F.lit("x" * 50), 100).alias("a"))
    assert not fits_broadcast(wide, Limits(max_bytes=40_000))
    assert fits_broadcast(wide, Limits(max_bytes=80_000))
    raw = spark.range(10).select(F.lit("x" * 5000).cast("binary").alias("a"))
    assert not fits_broadcast(raw, Limits(max_bytes=40_000))
