from rillstone.operators import checks
from rillstone.operators import diagnostics as D
from rillstone.streaming import arrivals


def test_arrivals_are_checked_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([(0,), (1,), (-2,)], "id long").write.parquet(src)
    run = lambda: arrivals.check_arrivals(arrivals.follow(spark, src, spark.read.parquet(src).schema), lambda b: D.each(b, checks.id_rules("catchment"), "catchments"), out, cp).awaitTermination()
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(0,)], "id long").write.mode("append").parquet(src)
    run()
    assert {(r.check_id, r["count"]) for r in spark.read.parquet(out).groupBy("check_id").count().collect()} == {("ids.catchment_zero", 2), ("ids.catchment_negative", 1)}


def test_counts_by_window(spark, tmp_path):
    """A window is given out once the watermark, two days behind the latest arrival, has passed its end."""
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = [(7, "2024-01-01 01:00:00"), (7, "2024-01-01 23:00:00"), (8, "2024-01-01 05:00:00"), (7, "2024-01-02 01:00:00"), (7, "2024-02-01 00:00:00")]
    spark.createDataFrame(rows, "feed int, at string").selectExpr("feed", "cast(at as timestamp) loaded_at").coalesce(1).write.parquet(src)
    stream = arrivals.follow(spark, src, spark.read.parquet(src).schema)
    counts = arrivals.counts_by_window(stream, "loaded_at")
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    late = spark.createDataFrame([(7, "2024-01-01 02:00:00")], "feed int, at string").selectExpr("feed", "cast(at as timestamp) loaded_at")
    late.write.mode("append").parquet(src)
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    got = {(r.window.start.day, r.feed): r.n_rows for r in spark.read.parquet(out).collect()}
    assert got == {(1, 7): 2, (1, 8): 1, (2, 7): 1}
