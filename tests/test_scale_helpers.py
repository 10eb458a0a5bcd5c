"""Helpers that spread hot groups: same results as the plain form, and no hot task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterdeck.operators.ordering import head_per_group, ordinal_blocks, positions
from quarterdeck.operators.skew import hot_keys, salted_join


def skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 500 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))
    )
    return spark.range(n).select(key.alias("key"), F.col("id").alias("ordinal"))


def test_hot_keys_are_cut_by_rows(spark):
    expected = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    for part_rows, parts in ((100, 20), (700, 3)):
        hot = {r["_hash"]: r["_parts"] for r in hot_keys(skewed(spark), ["key"], part_rows, 64).collect()}
        assert hot == {expected: parts}
    # Twice the rows: twice the parts, each as large as before.
    twice = skewed(spark).union(skewed(spark))
    assert [r["_parts"] for r in hot_keys(twice, ["key"], 100, 64).collect()] == [40]
    assert hot_keys(skewed(spark), ["key"], 2000, 64).count() == 0


def test_salted_join_equals_plain_join(spark, rows):
    large = skewed(spark)
    per_key = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "key string, v int")
    for how in ("left", "inner", "left_semi"):
        plain = large.join(per_key, ["key"], how)
        assert rows(salted_join(large, per_key, ["key"], ["ordinal"], how, 100)) == rows(plain), how


def test_salted_join_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        per_key = spark.createDataFrame([("hot", 1)], "key string, v int")
        joined = salted_join(skewed(spark), per_key, ["key"], ["ordinal"], "inner", 100)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sum(sizes) == 2000 and max(sizes) < 1000


def test_rows_without_a_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        lost = spark.range(4000).select(F.lit(None).cast("string").alias("key"), F.col("id").alias("ordinal"))
        joined = salted_join(lost, spark.createDataFrame([("k", 1)], "key string, v int"), ["key"], ["ordinal"])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sum(sizes) == 4000 and max(sizes) < 1000


def test_positions_equal_row_number(spark, rows):
    df = skewed(spark).withColumn("ordinal", F.col("ordinal") * 700_001 % 10_000_019 * 1000)
    plain = df.withColumn("position", F.row_number().over(Window.partitionBy("key").orderBy("ordinal")) - 1)
    plain = plain.withColumn("size", F.count("*").over(Window.partitionBy("key"))).filter("key is not null")
    blocks = [F.shiftright("ordinal", 30), F.shiftright("ordinal", 20)]
    got = positions(df.filter("key is not null"), ["key"], blocks, ["ordinal"], total="size")
    want = rows(plain, "key", "ordinal", "position", "size")
    assert rows(got, "key", "ordinal", "position", "size") == want
    one = positions(df.filter("key is not null"), ["key"], [F.col("ordinal") % 1], ["ordinal"], total="size")
    assert rows(one, "key", "ordinal", "position", "size") == want


def test_ordinal_blocks_keep_order(spark):
    values = [0, 1, (1 << 20) - 1, 1 << 20, 1 << 40, (1 << 41) + 5]
    df = spark.createDataFrame([(v,) for v in values], "ordinal long")
    blocked = df.select("ordinal", *(b.alias(f"b{i}") for i, b in enumerate(ordinal_blocks("ordinal")))).collect()
    assert [r["ordinal"] for r in sorted(blocked, key=lambda r: (r["b0"], r["b1"], r["ordinal"]))] == values


def test_head_per_group_limits_before_the_shuffle(spark, rows):
    df = skewed(spark)
    first = head_per_group(df, ["key"], ["ordinal"], 2, rank="rank")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(first.filter("key = 'hot'"), "ordinal", "rank") == [(0, 1), (3, 2)]


def test_positions_move_rows_once(spark):
    rows = spark.createDataFrame([(g, i, "text") for g in ("a", None) for i in [*range(40), None]], "g string, i long, body string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = positions(rows, ["g"], ordinal_blocks("i"), ["i"])
        plan = placed._jdf.queryExecution().executedPlan().toString()
        found = {(r.g, r.i): r.position for r in placed.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {(g, i): 0 if i is None else i + 1 for g in ("a", None) for i in [*range(40), None]}
    # One shuffle of the rows, for the window and the join, and one of the counts.
    assert plan.count("Exchange hashpartitioning(_place") == 2
