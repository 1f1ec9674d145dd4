from quillspark.session import LIGHT_BYTES, light


def test_light_measures_bytes(spark):
    wide = spark.createDataFrame([(i, "x" * 10_000) for i in range(20)], "k long, v string")
    rows = spark.range(100).withColumnRenamed("id", "k")
    plan = lambda df: rows.join(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(light(wide))
    assert "SortMergeJoin" in plan(light(wide, 100_000)) and "Broadcast" not in plan(light(wide, 100_000))
    assert rows.join(light(wide), "k").count() == rows.join(light(wide, 0), "k").count() == 20
    assert LIGHT_BYTES < 10 << 20
    assert light(wide.limit(0)).count() == 0
