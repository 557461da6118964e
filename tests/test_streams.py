"""Streams are drained to the shared folder, not to the driver."""

from pathlib import Path

from pyspark.sql import functions as F

from trustlake.streaming import streams


def test_drained_to_files(spark, tmp_path):
    for i in range(3):
        spark.range(10 * i, 10 * i + 15).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    all_rows, counts = streams.drained(stream()), streams.drained(stream().groupBy((F.col("id") % 2).alias("odd")).agg(F.count("*").alias("n")), "complete")
    assert all_rows.count() == 45 and {r["odd"]: r["n"] for r in counts.collect()} == {0: 24, 1: 21}
    files = all_rows.inputFiles()
    assert len(files) >= 3 and all("/stream-" in f and f.startswith("file:") for f in files)
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert not root or all(f.removeprefix("file:").lstrip("/").startswith(root.removeprefix("file:").strip("/")) for f in files)
    home = Path("/" + files[0].split("/out/")[0].removeprefix("file:").lstrip("/"))
    assert (home / "checkpoint" / "offsets").is_dir()
    (tmp_path / "none").mkdir()
    assert streams.drained(spark.readStream.schema("id long").parquet(f"{tmp_path}/none")).count() == 0


def test_slices_of_several_files_are_batches(spark):
    """Each slice has as many files, one that is empty too, and a stream reads them slice by slice."""
    second = [*range(0, 30), *range(70, 100)]
    rows = spark.createDataFrame([(s, s % 7 == 0) for s in second], "s long, late boolean").withColumn("ts", F.timestamp_seconds("s"))
    path, files = streams.in_slices(spark, rows, "ts", 3, F.col("late"), most=4)
    assert files == 4 and spark.read.schema(rows.schema).parquet(path).count() == 60
    assert len([f for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")]) == 4 * files
    seen = []
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
    stream.writeStream.foreachBatch(lambda b, n: seen.append(sorted(r["s"] for r in b.collect()))).trigger(availableNow=True).option("checkpointLocation", f"{path}-c").start().awaitTermination()
    on_time, late = [s for s in second if s % 7], [s for s in second if s % 7 == 0]
    assert seen == [[s for s in on_time if s < 33], [], sorted([s for s in on_time if s > 66] + [s for s in late if s < 33]), [s for s in late if s > 66]]


def test_pages_reconciling_and_gauges(spark, tmp_path):
    from trustlake.operators.filters import EventFilter
    from trustlake.schema import EVENTS
    from trustlake.sources.stores import EventStore

    rows = spark.createDataFrame([(f"e{i}", "x", i, 1, [], "", "") for i in range(8)], EVENTS)
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    gauges = streams.Gauges()
    spark.streams.addListener(gauges)
    try:
        got = streams.drained(streams.replica_stream(spark, f"{tmp_path}/in", EVENTS, EventFilter(since=2, until=6)))
        assert sorted(r["created_at"] for r in got.collect()) == [2, 3, 4, 5, 6]
        assert streams.drained(streams.replica_stream(spark, f"{tmp_path}/in", EVENTS, EventFilter(limit=3))).count() == 3
    finally:
        spark.streams.removeListener(gauges)
    store = EventStore(spark, f"file://{tmp_path}/events")
    store.insert(rows.where("created_at < 3"), 100)
    assert streams.reconciled(store, rows, 100) == 5 and streams.reconciled(store, rows, 100) == 0 and store.events().count() == 8


def test_enrolment_reaches_the_next_batch_of_a_store(spark, tmp_path):
    from trustlake.schema import EVENTS
    from trustlake.sources.stores import EventStore

    for i in range(3):
        spark.createDataFrame([(f"e{i}{who}", who, i, 1, [], "", "") for who in "ab"], EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    enrol = lambda who: spark.createDataFrame([(who,)], "pubkey string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/enrolled")
    enrol("a")
    enrol("a")
    seen = []

    def after_the_second(batch):
        seen.append(batch.count())
        if len(seen) == 2:
            enrol("b")

    store = EventStore(spark, f"file://{tmp_path}/events")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    totals = streams.into_store(stream, store, f"file://{tmp_path}/home", 100, hooks=(after_the_second,), each=streams.enrolled(f"{tmp_path}/enrolled"))
    assert seen == [1, 1, 2] and totals == {"received": 4, "stored": 4}
    assert sorted(r["id"] for r in store.events().collect()) == ["e0a", "e1a", "e2a", "e2b"]
