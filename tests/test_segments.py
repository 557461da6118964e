"""The store of segments, its commits, snapshots, the ledger and the history of passes."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trustlake.operators import store
from trustlake.schema import EVENTS, LEDGER
from trustlake.sources import stores
from trustlake.sources.commits import CommitConflict, Commits


def log(spark, rows):
    return spark.createDataFrame([(i, p, t, k, tags, "", "") for i, p, t, k, tags in rows], EVENTS)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_what_has_expired_on_arrival_changes_nothing(spark, tmp_path):
    held = stores.EventStore(spark, f"file://{tmp_path}/e")
    held.insert(log(spark, [("p", "x", 5, 0, []), ("n", "x", 1, 1, [])]), 100)
    late = log(spark, [("q", "x", 9, 0, [["expiration", "50"]]), ("d", "x", 9, 5, [["e", "n"], ["expiration", "50"]]), ("v", "x", 9, 62, [["expiration", "100"]])])
    report = held.insert_reported(late, 100)
    assert (report["offered"], report["expired"], report["stored"], report["removed"]) == (3, 3, 0, 0)
    assert ids(held.events()) == ["n", "p"]
    forged = held.insert_reported(log(spark, [("f", "x", 9, 5, [["e", "n"]]), (None, "x", 1, 1, [])]), 100, verified=F.col("id") != "f")
    assert forged["unverified"] == 2 and ids(held.events()) == ["n", "p"]


def test_an_insert_touches_the_segments_of_its_authors_only(spark, tmp_path):
    held = stores.EventStore(spark, f"file://{tmp_path}/e", buckets=8)
    held.insert(log(spark, [(f"{a}{i}", f"author{a}", i, 1, []) for a in range(40) for i in range(3)]), 100)
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    held.insert(log(spark, [("new", "author7", 9, 62, [])]), 100)
    bucket = {s.split("bucket=")[1] for s in held.touched["read"]}
    assert len(held.touched["read"]) == 1 and len(bucket) == 1
    assert sorted(s.split("what=")[1].split("/")[0] for s in held.touched["written"]) == ["dead", "rows"]
    assert {s.split("bucket=")[1] for s in held.touched["written"]} == bucket
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert ids(held.of_authors(["author7", "author8"])) == ["80", "81", "82", "new"]
    assert held.events().count() == 40 * 3 - 3 + 1
    held.insert(log(spark, [("other", "zzz", 1, 1, [])]), 100)
    assert not held.touched["read"] or "zzz" >= "author"  # a range that ends before an author is not read


def test_two_writers_lose_nothing(spark, tmp_path):
    home = f"file://{tmp_path}/e"
    one, two = stores.EventStore(spark, home, buckets=4), stores.EventStore(spark, home, buckets=4)
    one.insert(log(spark, [("a", "x", 1, 0, [])]), 100)
    attempts = []

    def between(document, part):
        # the other writer commits while this one is at work: first a newer profile of the same author
        attempts.append(part)
        if len(attempts) == 1:
            two.insert(log(spark, [("b", "x", 5, 0, []), ("m", "y", 1, 1, [])]), 100)
        old = one._live(document["segments"])
        new = log(spark, [("c", "x", 3, 0, [])]).withColumn("expires_at", F.lit(None).cast("long")).withColumn("part", F.lit(part))
        kept = store.stored_events(old.unionByName(new).drop("expires_at")).select("id")
        return new.join(kept, "id", "left_semi").withColumn("what", F.lit("rows")), lambda s: False

    one._change(between)
    assert len(attempts) == 2 and ids(one.events()) == ["b", "m"] == ids(two.events())
    numbers = [int(p.stem) for p in Path(f"{tmp_path}/e/commits").glob("*.json") if not p.name.startswith(".")]
    assert sorted(numbers) == list(range(len(numbers)))


def test_writers_of_other_buckets_are_put_on_top(spark, tmp_path):
    home = f"file://{tmp_path}/e"
    one, two = stores.EventStore(spark, home, buckets=64), stores.EventStore(spark, home, buckets=64)
    one.load(log(spark, [("a", "x", 1, 1, [])]))
    tries = []

    def work(document, part):
        tries.append(part)
        two.insert(log(spark, [("m", "y", 1, 1, [])]), 100)
        rows = log(spark, [("b", "x", 2, 1, [])]).withColumn("expires_at", F.lit(None).cast("long"))
        return rows.withColumn("part", F.lit(part)).withColumn("what", F.lit("rows")), lambda s: False

    one._change(work)
    assert len(tries) == 1 and ids(one.events()) == ["a", "b", "m"]


def test_marks_compaction_and_vacuum(spark, tmp_path):
    held = stores.EventStore(spark, f"file://{tmp_path}/e", buckets=4)
    for i in range(5):
        held.insert(log(spark, [(f"e{i}", "x", i, 1, []), (f"p{i}", "x", i, 0, []), (f"n{i}", f"y{i}", i, 1, [["expiration", "200"]] if i == 3 else [])]), 100)
    assert ids(held.events()) == sorted([f"e{i}" for i in range(5)] + ["p4"] + [f"n{i}" for i in range(5)])
    assert held.delete(F.col("id").isin("e1", "e2"), authors=["x"]) == 2 and held.delete(F.col("sig") == "never") == 0
    assert held.sweep(200) == 1 and held.sweep(200) == 0
    want = ids(held.events())
    assert held.insert(log(spark, [("e1", "x", 1, 1, [])]), 100) == 1  # what was only deleted from the store may come again
    held.compact(most=1)
    document = held._latest()[1]
    assert not any(s["dead"] for s in document["segments"]) and len(document["segments"]) == len({s["bucket"] for s in document["segments"]})
    assert ids(held.events()) == sorted([*want, "e1"])
    files = len(list(Path(tmp_path).rglob("*.parquet")))
    held.vacuum(keep=1)
    assert ids(held.events()) == sorted([*want, "e1"]) and len(list(Path(tmp_path).rglob("*.parquet"))) < files
    assert not list(Path(f"{tmp_path}/e/staging").iterdir())


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_what_the_rules_give_at_once(spark, tmp_path, seed):
    rng, rows = random.Random(seed), []
    for i in range(150):
        kind = rng.choice([0, 1, 1, 3, 30000, 30382, 5, 5, 62 if rng.random() < 0.1 else 1, 20001])
        tags = [["d", rng.choice("ab")]] if kind >= 30000 else [["e", f"{rng.randrange(150):03d}"], ["a", f"30000:u{rng.randrange(4)}:a"]] if kind == 5 else []
        rows.append((f"{i:03d}", f"u{rng.randrange(4)}", rng.randrange(40), kind, tags))
    rows.sort(key=lambda r: r[2])  # in the order of time, batches see what one pass sees
    held = stores.EventStore(spark, f"file://{tmp_path}/e", buckets=3)
    cuts = [rows[i : i + 50] for i in range(0, 150, 50)]
    for part in cuts:
        held.insert(log(spark, part + part[:5]), 10**6)
    simple = lambda r: r
    assert ids(held.events()) == sorted(brute(simple(rows)))


def brute(rows):
    """Ids that stay, one event after another in the order given."""
    held = {}
    for i, p, t, k, tags in rows:
        if 20000 <= k <= 29999 or i in held:
            continue
        named = [x for r in held.values() if r[3] == 5 and r[1] == p for x in r[4]]
        mine = {r[0]: r for r in held.values() if r[1] == p}
        if k not in (5, 62) and (["e", i] in named or any(n[0] == "a" and tags and n[1] == f"{k}:{p}:{tags[0][1]}" and t <= r[2] for r in mine.values() if r[3] == 5 for n in r[4])):
            continue
        if k != 62 and any(r[3] == 62 and t <= r[2] for r in mine.values()):
            continue
        slot = lambda r: (r[3], "" if r[3] in (0, 3) or 10000 <= r[3] <= 19999 else r[4][0][1] if 30000 <= r[3] <= 39999 else r[0])
        same = [r for r in mine.values() if slot(r) == slot((i, p, t, k, tags))]
        if any((-r[2], r[0]) < (-t, i) for r in same):
            continue
        for r in same:
            del held[r[0]]
        if k == 62:
            held = {x: r for x, r in held.items() if r[1] != p or r[2] > t or r[3] == 62}
        if k == 5:
            for name, value in tags:
                for x in [x for x, r in held.items() if r[1] == p and r[3] not in (5, 62) and (name == "e" and x == value or name == "a" and r[3] >= 30000 and value == f"{r[3]}:{p}:{r[4][0][1]}" and r[2] <= t)]:
                    del held[x]
        held[i] = (i, p, t, k, tags)
    return list(held)


def test_commits_are_never_overwritten_or_lost(spark, tmp_path):
    c = Commits(spark, f"file://{tmp_path}/t")
    assert c.latest() == (-1, {})
    assert c.commit(0, {"a": 1}) and not c.commit(0, {"a": 2}) and c.commit(1, {"a": "é"})
    assert c.latest() == (1, {"a": "é"}) and c.at(0) == {"a": 1}
    (tmp_path / "lost/data/x").mkdir(parents=True)
    with pytest.raises(ValueError, match="no commit"):
        stores.Snapshots(spark, f"file://{tmp_path}/lost", LEDGER).read()


def test_ledger_upserts_and_snapshots(spark, tmp_path):
    led = stores.StoredLedger(spark, f"file://{tmp_path}/l")
    authors = spark.createDataFrame([("a",), ("b",)], "pubkey string")
    assert led.synced_count() == 0 and led.read().count() == 0
    led.mark_synced(authors, 100)
    old = led.read()
    led.mark_outbox_checked(authors.where("pubkey = 'b'"), 200)
    led.mark_synced(spark.createDataFrame([("c",)], "pubkey string"), 300)
    assert {tuple(r) for r in led.read().collect()} == {("a", 100, 0), ("b", 100, 200), ("c", 300, 0)}
    assert [tuple(r) for r in led.get("b").collect()] == [("b", 100, 200)] and led.get("z").count() == 0
    assert led.synced_count() == 3 and [r["pubkey"] for r in led.due_for_refresh(150, 1).collect()] == ["a"]
    assert [r["pubkey"] for r in led.synced_since(200).collect()] == ["c"] and [r["pubkey"] for r in led.outbox_checked().collect()] == ["b"]
    assert {tuple(r) for r in old.collect()} == {("a", 100, 0), ("b", 100, 0)}  # a reader keeps its version
    version = led.table.version()
    led.table.swap(led.read(), version)
    with pytest.raises(CommitConflict):
        led.table.swap(led.read(), version)
    led.table.vacuum(keep=1)
    assert led.read().count() == 3


def test_history_of_passes(spark, tmp_path):
    held, history = stores.EventStore(spark, f"file://{tmp_path}/e"), stores.PassHistory(spark, f"file://{tmp_path}/p")
    assert history.read().count() == 0
    for n in range(3):
        e = log(spark, [(f"e{n}", "x", n, 1, []), (f"e{n}", "x", n, 1, []), ("p", "x", 1, 0, []), (f"x{n}", "x", n, 20001, [])])
        history.append(n, 10 * n, [held.insert_reported(e, 100)])
    rows = [r.asDict() for r in history.newest(2).collect()]
    assert [r["pass"] for r in rows] == [2, 1]
    assert {k: rows[0][k] for k in ("offered", "ephemeral", "duplicate", "known", "refused", "stored")} == {"offered": 4, "ephemeral": 1, "duplicate": 1, "known": 1, "refused": 0, "stored": 1}


def test_guards_judge_each_scope(spark):
    from trustlake.sources import tables

    save = tables.saver(spark)
    held = spark.createDataFrame([("s", i, i < 4) for i in range(4)] + [("t", i, i < 3) for i in range(96)] + [(None, 1, True)], "scope string, n int, gone boolean")
    assert sorted(r["scope"] for r in store.guarded(held, save, scope=["scope"]).collect()) == ["t"] * 3
    assert len(store.guarded(held, save, scope=["scope"], spared=4).collect()) == 8
    assert {(r["scope"], r["n"], r["gone"]) for r in store.refused_scopes(held, ["scope"]).collect()} == {("s", 4, 4), (None, 1, 1)}
    with pytest.raises(store.MassDeletion):
        store.guarded(held.where("scope = 's'"), save)


def test_orphans_need_a_list(spark):
    from trustlake.operators import trust
    from trustlake.sources import tables

    scored = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3)], "service string, subject int")
    none = spark.createDataFrame([], "observer string, service string")
    some = spark.createDataFrame([("o", "s1"), ("o", "s2"), ("o", "s2")], "observer string, service string")
    assert trust.orphans(scored, none).count() == 0 and [r["service"] for r in trust.orphans(scored, some).collect()] == ["s3"]
    save = tables.saver(spark)
    assert trust.swept_orphans(scored, none, save).count() == 0 and trust.swept_orphans(scored, some, save).count() == 1
    with pytest.raises(store.MassDeletion):
        trust.swept_orphans(scored, some.where("service = 's1'"), save)


def test_routing_takes_reachable_relays(spark):
    from trustlake.operators import trust

    authors = spark.createDataFrame([("a",), ("b",), ("c",)], "author string")
    lists = spark.createDataFrame([("a", "ws://localhost:1", 0), *[("a", f"wss://r{i}.example", i + 1) for i in range(5)], ("b", "ws://10.0.0.1", 0)], "author string, relay string, pos int")
    found = lambda *a, **k: sorted(tuple(r) for r in trust.routed(authors, lists, *a, **k).collect())
    assert found(["wss://f.example"]) == [("a", f"wss://r{i}.example") for i in range(4)] + [("b", "wss://f.example"), ("c", "wss://f.example")]
    assert found([]) == [("a", f"wss://r{i}.example") for i in range(4)]
    assert len([r for r in found([f"wss://f{i}.example" for i in range(3)]) if r[0] == "b"]) == 2


def test_batches_without_authors_end_a_streak(spark):
    from trustlake.operators import state

    batches = spark.createDataFrame([("r", 1, 0, 60), ("r", 2, 0, 0), ("r", 3, 0, 60), ("s", 1, 0, 60), ("s", 2, 0, 60)], "relay string, batch int, downloaded long, authors long")
    assert [tuple(r) for r in state.low_yield_relays(batches, spark.createDataFrame([], "relay string")).collect()] == [("s", 2)]
