"""Duplicate removal: same survivor whatever the layout, hot keys, NULL keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from faregrid.operators import dedup, lookups


def hot(spark, rows=60_000):
    """A third of all rows share one key."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 1000).alias("k"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 2).alias("k2"),
        (F.col("id") * 7919 % 10007).alias("v"),
        F.concat(F.lit("x"), F.col("id") % 5).alias("s"),
    )


def test_survivor_does_not_depend_on_layout(spark):
    rows = hot(spark)
    hashed = [dedup.first_per_key(r, ["k", "k2"]) for r in (rows.repartition(1), rows.repartition(13, "v"))]
    assert hashed[0].exceptAll(hashed[1]).count() == 0 and hashed[1].exceptAll(hashed[0]).count() == 0
    few = dedup.first_per_key(rows.repartition(1), ["k", "k2"], ["v", "s"])
    many = dedup.first_per_key(rows.repartition(13, "v"), ["k", "k2"], ["v", "s"])
    assert few.exceptAll(many).count() == 0 and many.exceptAll(few).count() == 0
    expected = rows.groupBy("k", "k2").agg(F.min(F.struct("v", "s")).alias("m"))
    expected = expected.select("k", "k2", "m.v", "m.s")
    assert few.exceptAll(expected).count() == 0 and few.count() == expected.count()


def test_repeats_are_dropped_before_the_shuffle(spark, plan_text):
    plan = plan_text(dedup.first_per_key(hot(spark), ["k", "k2"]))
    assert "row_number(), 1, Partial" in plan
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_only_needed_columns_are_moved(spark, tmp_path, plan_text):
    wide = hot(spark).withColumns({f"w{i}": F.concat("s", F.lit(i)) for i in range(5)})
    wide.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    plan = plan_text(dedup.first_per_key(stored, ["k", "k2"], ["v"]).groupBy("k").agg(F.sum("v")))
    moved = plan[plan.index(") Exchange\n"):]
    assert "w3" not in moved[: moved.index("Arguments")]


def test_complete_order_reads_no_other_column(spark, tmp_path, plan_text):
    wide = hot(spark).withColumns({f"w{i}": F.concat("s", F.lit(i)) for i in range(5)})
    wide.write.parquet(str(tmp_path / "ordered"))
    stored = spark.read.parquet(str(tmp_path / "ordered"))
    kept = dedup.first_per_key(stored, ["k", "k2"], ["v"], complete=True)
    plan = plan_text(kept.groupBy("k").agg(F.sum("v")))
    assert "w3" not in plan[plan.rindex("ReadSchema"):].splitlines()[0] and "xxhash64(" not in plan
    assert sorted(r.v for r in kept.collect()) == sorted(
        r.v for r in dedup.first_per_key(stored, ["k", "k2"], ["v"]).collect()
    )
    bare = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert dedup.first_per_key(bare, ["k"]).count() == 2


def test_missing_keys_are_equal(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    assert sorted(r.v for r in dedup.first_per_key(rows, ["k"], ["v"]).collect()) == [1, 5]


def test_tie_break_columns(spark):
    rows = spark.createDataFrame([(1, 9, "late"), (1, 2, "early")], "k int, offset int, v string")
    kept = dedup.first_per_key(rows, ["k"], tie_break=["offset"]).first()
    assert kept.v == "early"


def test_removed_rows(spark):
    rows = hot(spark, 3000)
    found = dedup.removed_rows(rows, ["k", "k2"]).first()
    assert found.rows_before == 3000
    assert found.rows_after == dedup.first_per_key(rows, ["k", "k2"]).count()
    assert found.rows_removed == found.rows_before - found.rows_after
    empty = dedup.removed_rows(rows.filter("k < 0"), ["k", "k2"]).first()
    assert tuple(empty) == (0, 0, 0)


def test_left_join_guard(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "pickup_date_str string, pickup_hour int")
    right = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 1, 2.0)],
        "pickup_date_str string, pickup_hour int, weather_temp_c double",
    )
    joined = lookups.with_weather(left, right)
    guard = lookups.row_count_guard(left, joined, right, lookups.WEATHER_KEYS).first()
    assert tuple(guard) == (2, 3, 1, False)
