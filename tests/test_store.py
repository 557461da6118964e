"""Current state, trust graph and settings on small event logs."""

import pytest

from trustlake.functions import columns as C
from trustlake.operators import store, trust
from trustlake.operators.filters import EventFilter
from trustlake.schema import EVENTS, LEDGER
from trustlake.sources import tables

from pyspark.sql import functions as F


def log(spark, rows):
    return spark.createDataFrame([(i, p, t, k, tags, "", "") for i, p, t, k, tags in rows], EVENTS)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_supersession_tie_goes_to_lowest_id(spark):
    e = log(spark, [("b", "x", 5, 0, []), ("a", "x", 5, 0, []), ("c", "x", 4, 0, []), ("n1", "x", 1, 1, []), ("n2", "x", 2, 1, [])])
    assert ids(store.current_events(e, 100)) == ["a", "n1", "n2"]


def test_erasure_is_inclusive_and_keeps_the_request(spark):
    e = log(spark, [("n", "x", 10, 1, []), ("v", "x", 10, 62, []), ("late", "x", 9, 1, []), ("after", "x", 11, 1, []), ("other", "y", 1, 1, [])])
    assert ids(store.current_events(e, 100)) == ["after", "other", "v"]


def test_deletion_binds_its_author_and_spares_deletions(spark):
    e = log(spark, [("n", "x", 1, 1, []), ("m", "y", 1, 1, []), ("d", "x", 2, 5, [["e", "n"], ["e", "m"]]), ("d2", "x", 3, 5, [["e", "d"]])])
    assert ids(store.current_events(e, 100)) == ["d", "d2", "m"]


def test_deletion_by_address_is_bounded_in_time(spark):
    e = log(spark, [("s1", "x", 5, 30000, [["d", "k"]]), ("del", "x", 6, 5, [["a", "30000:x:k"]]), ("s2", "x", 7, 30001, [["d", "k"]])])
    assert ids(store.current_events(e, 100)) == ["del", "s2"]


def test_expired_and_ephemeral_are_absent(spark):
    e = log(spark, [("old", "x", 1, 1, [["expiration", "50"]]), ("new", "x", 1, 1, [["expiration", "500"]]), ("eph", "x", 1, 20001, [])])
    assert ids(store.current_events(e, 100)) == ["new"]


def test_coverage(spark):
    e = log(spark, [("t", "obs", 1, 10040, [["30382:rank", "svc", "wss://p"]])] + [(f"s{i}", "svc", 2, 30382, [["d", s], ["rank", r]]) for i, (s, r) in enumerate([("alice", "90"), ("bob", "50"), ("carol", "20")])] + [(f"r{p}", p, 1, 10002, [["r", "wss://o"]]) for p in ("alice", "bob")])
    ledger = spark.createDataFrame([("alice", 2000, 2000), ("bob", 0, 2000), ("carol", 2000, 2000)], LEDGER)
    row = trust.coverage(trust.provider_edges(e), trust.scores(e), trust.relay_lists(e), ledger).first()
    assert (row["providers"], row["roster"], row["with_own_outbox"], row["synced"], row["pending"], row["unreached"]) == (1, 3, 2, 2, 1, 0)


def test_stale_is_guarded(spark):
    held, none = spark.createDataFrame([(str(i),) for i in range(10)], "id string"), spark.createDataFrame([], "id string")
    with pytest.raises(ValueError):
        store.stale(held, none, True, tables.saver(spark))
    assert store.stale(held, none, False, tables.saver(spark)).count() == 0


def test_refresh_slice(spark):
    ledger = spark.createDataFrame([("aa", 100, 0), ("bb", 200, 0), ("cc", 300, 0), ("dd", 5000, 0), ("ee", 0, 200)], LEDGER)
    assert [r["pubkey"] for r in store.refresh_slice(ledger, 1000, 2).collect()] == ["aa", "bb"]
    assert store.refresh_slice(ledger, 1000, 0).count() == 0


def test_frontier_survives_cycles(spark, tmp_path):
    edges = spark.createDataFrame([("a", "s1", "r"), ("b", "s2", "r"), ("c", "s3", "r"), ("d", "s4", "r")], "observer string, service string, relay string")
    scored = spark.createDataFrame([("s1", "b"), ("s2", "a"), ("s2", "c"), ("s4", "a")], "service string, subject string")
    found = trust.frontier(edges, scored, spark.createDataFrame([("a",)], "observer string"), f"file://{tmp_path}/walk")
    assert {(r["observer"], r["depth"]) for r in found.collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_routable(spark):
    bad = ["ws://10.0.1.24:4848", "ws://192.168.1.10", "ws://172.16.5.5", "ws://100.103.119.73:4848", "ws://127.0.0.1:7777", "ws://169.254.1.1", "ws://localhost:4869", "ws://x.local", "ws://x.onion", "no url"]
    good = ["wss://127.example.com", "wss://10.relay.example", "wss://relay.example.com", "wss://a.example.org/path", "wss://10up.io", "wss://13.50.72.62"]
    df = spark.createDataFrame([(u,) for u in bad + good], "url string").select("url", C.routable(F.col("url")).alias("ok"))
    assert {r["url"] for r in df.collect() if r["ok"]} == set(good)


def test_empty_list_matches_nothing(spark):
    e = log(spark, [("a", "x", 1, 1, [])])
    assert e.where(EventFilter(kinds=()).predicate()).count() == 0 and e.where(EventFilter(since=1, until=1).predicate()).count() == 1


def test_dotenv(spark, tmp_path):
    (tmp_path / "env").write_text("# note\nexport A=\"quoted name\"\nB=7\nC='x=y'\nnothing\n")
    assert {(r["key"], r["value"]) for r in tables.dotenv(spark, str(tmp_path / "env")).collect()} == {("A", "quoted name"), ("B", "7"), ("C", "x=y")}


def test_need_have_meets_each_side_once(spark):
    """Repeated and null keys, and as many exchanges as there are sides at most."""
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    got = lambda a, b: sorted(map(tuple, store.need_have(a, b).collect()), key=repr)
    assert got(rows(1, 1, 2, 3), rows(3, 4, 4)) == [(1, "have"), (2, "have"), (4, "need")]
    assert got(rows(1, None, None), rows(1, None)) == [(None, "have"), (None, "need")]
    assert got(rows(), rows(5)) == [(5, "need")] and got(rows(), rows()) == []
    plan = store.need_have(rows(1), rows(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_the_log_is_made_in_many_tasks(spark):
    """However few files the events are in."""
    assert tables.event_log(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
