"""Keyed state that ends, windows that late rows reach, keys and cells."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from trustlake.functions import keys, places
from trustlake.streaming import streams


START = 1_000_000_000


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, event_type string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + START)).drop("s")


def stream_of(spark, path, *batches):
    for b in batches:
        b.coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def test_marks_lapse_without_events_and_state_goes(spark, tmp_path):
    day = 86400
    one = events(spark, [(1, 1, "error", 0), (2, 1, "error", 10), (3, 2, "error", 20), (4, 3, "view", 30)])
    two = events(spark, [(5, 2, "error", 60), (6, 3, "error", 70), (7, 2, "view", 80)])
    far = events(spark, [(8, 9, "view", 10 * day)])
    stream = stream_of(spark, tmp_path, one, two, far)
    for name, value in streams.STATE_STORE.items():
        spark.conf.set(name, value)
    got, progress = [], []
    query = streams.error_marks(stream, 2, float(day), "1 minute").writeStream.foreachBatch(lambda b, n: got.extend((n, *r) for r in b.collect())).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination()
    progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    rows = [(n, user, errors, dead is not None) for n, user, errors, dead, _ in sorted(got, key=lambda r: (r[0], r[1]))]
    assert rows[:5] == [(0, 1, 2, True), (0, 2, 1, False), (0, 3, 0, False), (1, 2, 0, False), (1, 3, 1, False)]
    lapsed = [r for r in rows if r[0] > 1 and r[1] in (1, 3)]
    assert [r[1:] for r in lapsed] == [(1, 0, False), (3, 0, False)]  # no event of theirs came
    assert len(got) == len({r[:2] for r in got})  # one row a key and batch
    total = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(total) > 0 and total[-1] == 0
    last = streams.latest(spark.createDataFrame([r[1:] for r in got], streams.CHANGES))
    assert last.count() == 4 and last.where("errors > 0").count() == 0


def test_marks_of_many_users_share_calls_and_state(spark, tmp_path):
    """Users of few groups, one without an id, against a recount by user; a group is one row of state."""
    import random

    rng, ttl, rows = random.Random(5), 50, []
    for b in range(3):
        rows.append([(1000 * b + i, rng.choice([None, *range(40)]), rng.choice(["error", "error", "error", "view"]), 100 * b + rng.randrange(100)) for i in range(300)])
    want = {}
    for batch in rows:
        for i, user, kind, s in sorted(batch, key=lambda r: (r[3], r[0])):
            errors, last = want.get(user, (0, 0))
            want[user] = ((errors if errors and s - last < ttl else 0) + 1, s) if kind == "error" else (0, s)
    stream = stream_of(spark, tmp_path, *[events(spark, b) for b in rows])
    for name, value in streams.STATE_STORE.items():
        spark.conf.set(name, value)
    got = []
    query = streams.error_marks(stream, 2, float(ttl), "1 day", groups=3).writeStream.foreachBatch(lambda b, n: got.extend(tuple(r) for r in b.collect())).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination()
    last = streams.latest(spark.createDataFrame(got, streams.CHANGES)).select("user_id", "errors", F.unix_millis("at").alias("at"), F.unix_millis("dead_until").alias("dead")).collect()
    assert {r["user_id"]: (r["errors"], r["at"] // 1000 - START) for r in last} == want
    assert all(r["dead"] == (r["at"] + 1000 * ttl if r["errors"] >= 2 else None) for r in last)
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert 0 < max(held) <= 4 * 3  # a value and its timer in its indexes, for three groups and those without an id


def test_late_rows_reach_their_windows(spark, tmp_path):
    batches = [events(spark, [(1, 1, "a", 5), (2, 1, "b", 95)]), events(spark, [(3, 1, "a", 500)]), events(spark, [(4, 1, "a", 7), (5, 1, "b", 505), (6, 1, "a", 8)]), events(spark, [(7, 1, "a", 900), (8, 1, "b", 96)])]
    stream = stream_of(spark, tmp_path, *batches)
    held = streams.LateWindows(spark, f"file://{tmp_path}/w", "ts", 100_000, 60_000, ["event_type"])
    stream.writeStream.foreachBatch(held.put).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()
    found = lambda: sorted((r[0] - 1000 * START, *r[1:]) for r in held.windows().collect())
    assert found() == [(0, "a", 1), (0, "b", 1), (500_000, "a", 1), (500_000, "b", 1), (900_000, "a", 1)]
    schema = batches[0].schema
    assert sorted(r["event_id"] for r in held.late(schema).collect()) == [4, 6, 8]
    held.put(batches[2], 2)  # a batch that comes again changes nothing
    assert held.backfill(schema) == 2
    want = sorted(((0, "a", 3), (0, "b", 2), (500_000, "a", 1), (500_000, "b", 1), (900_000, "a", 1)))
    assert found() == want and held.late(schema).count() == 0
    assert held.backfill(schema) == 0 and found() == want
    assert Path(f"{tmp_path}/w/commits").is_dir()


def test_published_keys(spark):
    known = {
        "npub10elfcs4fr0l0r8af98jlmgdh9c8tcxjvz9qkw038js35mp4dma8qzvjptg": "7e7e9c42a91bfef19fa929e5fda1b72e0ebc1a4c1141673e2794234d86addf4e",
        "npub180cvv07tjdrrgpa0j7j7tmnyl2yr6yr7l8j4s3evf6u64th6gkwsyjh6w6": "3bf0c63fcb93463407af97a5e5ee64fa883d107ef9e558472c4eb9aaaefa459d",
    }
    word = next(iter(known))
    bad = ["", None, "npub1", word[:-1], word + "q", word[:-1] + "q", "Npub" + word[4:], word.replace("npub", "nsec"), word.replace("e", "b", 1), "ab" * 31, "xy" * 32]
    df = spark.createDataFrame([(w, k) for w, k in known.items()] + [(f" {w.upper()}\n".replace("\n", " "), k) for w, k in known.items()] + [(w, None) for w in bad], "w string, k string")
    for r in df.select("w", "k", keys.resolved_key(F.col("w")).alias("got"), keys.key_word(F.col("k")).alias("back")).collect():
        assert r["got"] == r["k"], r["w"]
        assert r["back"] == (r["w"].strip().lower() if r["k"] else None)


def test_published_profiles(spark):
    """The profile that the format's text gives as its example, and records in other orders, cut off or without a key."""
    known = "nprofile1qqsrhuxx8l9ex335q7he0f09aej04zpazpl0ne2cgukyawd24mayt8gpp4mhxue69uhhytnc9e3k7mgpz4mhxue69uhkg6nzv9ejuumpv34kytnrdaksjlyr9p"
    key = "3bf0c63fcb93463407af97a5e5ee64fa883d107ef9e558472c4eb9aaaefa459d"
    hint = "010d7773733a2f2f722e782e636f6d"
    whole = f"0020{key}{hint}01157773733a2f2f646a6261732e7361646b622e636f6d"
    rows = [(whole, key), (f"0020{key}", key), (f"{hint}0020{key}", key), (f"0503ffffff0100{hint}0020{key}", key), (f"{hint}{hint}{hint}", None), (f"001f{key[2:]}{hint}", None)]
    rows += [(f"{hint}{hint}0120{key[:40]}", None), (f"{hint}{hint}0020{key[:62]}", None), (f"0020{key}0020{'ab' * 32}", key), ("00", None), (None, None)]
    df = spark.createDataFrame(rows, "records string, want string").withColumn("word", keys.profile_word(F.col("records")))
    got = df.select("records", "want", "word", keys.resolved_key(F.upper("word")).alias("got"), keys.resolved_key(F.concat(F.lit(" "), "word")).alias("lower")).collect()
    assert next(r["word"] for r in got if r["records"] == whole) == known
    assert all(r["got"] == r["lower"] == r["want"] for r in got)
    bad = spark.createDataFrame([(w,) for w in (known[:-1], known + "q", known[:-1] + "q", "N" + known[1:], known.replace("nprofile", "nprofila"), known[:20] + known[21:], "nprofile1")], "w string")
    assert {r[0] for r in bad.select(keys.resolved_key(F.col("w"))).collect()} == {None}


def test_keys_are_resolved_in_many_tasks(spark):
    """However few files the parts are in."""
    from trustlake.plans import QUERIES

    assert QUERIES["key_resolution"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_published_cells(spark):
    rows = [(57.64911, 10.40744, "u4pruydqqvj"), (42.6, -5.6, "ezs42e44yx9"), (90.0, 180.0, "z" * 11), (-90.0, -180.0, "0" * 11), (91.0, 0.0, None), (None, 0.0, None)]
    df = spark.createDataFrame(rows, "lat double, lon double, want string")
    for r in df.select("want", places.cell(F.col("lat"), F.col("lon"), 11).alias("got"), places.cells_near(F.col("lat"), F.col("lon"), 1).alias("near")).collect():
        assert r["got"] == r["want"] and (r["near"] is None) == (r["want"] is None)
