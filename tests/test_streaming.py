from pyspark.sql import functions as F

from lociq.streaming import incremental


def test_running_summary_and_windows(spark, tmp_path):
    src = tmp_path / "in"
    a = spark.createDataFrame([(1, 0, 100, 900, 0, 0), (2, 0, 100, 900, 0, 0)], "read_id int, ref_id int, ref_start int, ref_end int, left_clip int, right_clip int")
    a.write.parquet(str(src))
    targets = spark.createDataFrame([(0, "x", 500)], "ref_id int, uuid string, n int")
    out = incremental.running_summary(incremental.stream_parquet(spark, str(src), a.schema), targets)
    q = out.writeStream.outputMode("complete").format("memory").queryName("running").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("running").first().n_tail_head_reads == 2

    ev = spark.createDataFrame([(k, f"2024-01-0{1 + k // 3} 00:00:00", "a", 1.0) for k in range(7)], "event_id int, t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    ev.write.parquet(str(tmp_path / "ev"))
    w = incremental.windowed_counts(incremental.stream_parquet(spark, str(tmp_path / "ev"), ev.schema))
    q = w.writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("windows").collect()] == [3]  # later windows are still open
    d = incremental.first_seen(incremental.stream_parquet(spark, str(tmp_path / "ev"), ev.schema), ["event_type"])
    q = d.writeStream.outputMode("append").format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c3")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("firsts").count() == 1
