"""Discovery, state, stores, verification and streams into stores on small event logs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from trustlake.functions import columns as C
from trustlake.functions import verify
from trustlake.operators import discovery, search, state, store, trust
from trustlake.schema import EVENTS
from trustlake.sources import stores, tables
from trustlake.streaming import streams


def log(spark, rows):
    return spark.createDataFrame([(i, p, t, k, tags, c, "") for i, p, t, k, tags, c in rows], EVENTS)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_index_relays_fall_back_to_seeds(spark):
    e = log(spark, [("a", "me", 1, 10086, [["relay", "wss://old"]], ""), ("b", "me", 2, 10086, [["relay", "wss://x"], ["relay", "wss://y"], ["relay", "wss://x"]], ""), ("c", "you", 1, 10086, [], "")])
    names = lambda who: [r["relay"] for r in discovery.index_relays(e, who, ["wss://s"]).orderBy("pos").collect()]
    assert names("me") == ["wss://x", "wss://y"] and names("you") == ["wss://s"] and names("none") == ["wss://s"]


def test_crawl_reaches_observers_through_scores(spark, tmp_path):
    on = lambda relay, *e: (relay, *e, "")
    rows = [
        on("idx", "t1", "house", 1, 10040, [["30382:rank", "svc", "prov"]], ""),
        on("idx", "t2", "alice", 1, 10040, [["30382:rank", "svc2", "prov"]], ""),
        on("idx", "t3", "zoe", 1, 10040, [["30382:rank", "svc3", "prov"]], ""),
        on("idx", "l1", "alice", 1, 10002, [["r", "wss://out.example"]], ""),
        on("wss://out.example", "t4", "alice", 9, 10040, [["30382:rank", "svc4", "prov"]], ""),
        on("prov", "s1", "svc", 1, 30382, [["d", "alice"], ["rank", "9"]], ""),
        on("prov", "s2", "svc4", 1, 30382, [["d", "bob"], ["rank", "7"]], ""),
        on("prov", "s3", "svc2", 1, 30382, [["d", "carol"], ["rank", "7"]], ""),
    ]
    replicas = spark.createDataFrame(rows, "relay string, id string, pubkey string, created_at long, kind int, tags array<array<string>>, content string, sig string")
    found = discovery.crawl(replicas, "house", ["idx"], f"file://{tmp_path}/a")
    assert {r["observer"] for r in found["observers"].collect()} == {"house", "alice"}
    assert {(r["observer"], r["service"]) for r in found["edges"].collect()} == {("house", "svc"), ("alice", "svc4")}
    assert {r["subject"] for r in found["scores"].collect()} == {"alice", "bob"}
    every = discovery.crawl(replicas, "house", ["idx"], f"file://{tmp_path}/b", connected_only=False)
    assert {r["observer"] for r in every["observers"].collect()} == {"house", "alice", "zoe"}


def test_store_rules(spark, tmp_path):
    held = stores.EventStore(spark, f"file://{tmp_path}/events")
    assert held.events().count() == 0
    first = log(spark, [("a", "x", 5, 0, [], ""), ("b", "x", 6, 0, [], ""), ("old", "x", 1, 1, [["expiration", "50"]], ""), ("eph", "x", 1, 20001, [], ""), ("n", "x", 1, 1, [], ""), ("m", "y", 1, 1, [], "")])
    assert held.insert(first, 100) == 3 and ids(held.events()) == ["b", "m", "n"]
    assert held.insert(first, 100) == 0
    assert held.insert(log(spark, [("d", "x", 7, 5, [["e", "n"], ["e", "m"]], ""), ("c", "x", 4, 0, [], "")]), 100) == 1
    assert ids(held.events()) == ["b", "d", "m"]
    assert held.insert(first.where("id = 'n'"), 100) == 0
    assert held.insert(log(spark, [("v", "y", 9, 62, [], ""), ("late", "y", 9, 1, [], "")]), 100) == 1 and ids(held.events()) == ["b", "d", "v"]
    assert held.insert(log(spark, [("soon", "y", 10, 1, [["expiration", "101"]], "")]), 100) == 1
    assert "soon" in ids(store.id_snapshot(held.events())) and "soon" not in ids(store.current_events(held.events(), 101))
    held.sweep(101)
    held.delete(F.col("kind") == 62)
    assert ids(held.events()) == ["b", "d"]


def test_absence_needs_one_relay_and_a_complete_listing(spark):
    save = tables.saver(spark)
    held = spark.createDataFrame([(f"s{i}", "one") for i in range(6)] + [("t0", "two"), ("u0", "part")], "id string, service string")
    edges = spark.createDataFrame([("o", "one", "r1"), ("o", "two", "r1"), ("p", "two", "r2"), ("o", "part", "r3"), ("q", "one", None)], "observer string, service string, relay string")
    listings = spark.createDataFrame([("r1", True, False), ("r2", True, False), ("r3", True, True)], "relay string, complete boolean, capped boolean")
    served = spark.createDataFrame([(f"s{i}", "r1") for i in range(1, 6)] + [("s0", "r2")], "id string, relay string")
    homes = trust.single_relay_services(edges)
    assert ids(store.absence_deletions(held, served, homes, listings, save)) == ["s0"]
    assert ids(store.absence_deletions(held, served.limit(0), homes, listings, save)) == []


def test_state(spark):
    cursors = spark.createDataFrame([("a", "1", 50), ("b", "1", 70)], "relay string, scope string, last_synced_at long")
    runs = spark.createDataFrame([("a", "1", 90, False), ("a", "1", 40, True), ("c", "2", 5, True), ("d", "1", 5, False)], "relay string, scope string, ended_at long, completed boolean")
    assert {tuple(r) for r in state.advanced_cursors(cursors, runs).collect()} == {("a", "1", 40), ("b", "1", 70), ("c", "2", 5)}
    known = spark.createDataFrame([("a", True), ("b", None), ("c", None), ("e", None)], "relay string, capable boolean")
    seen = spark.createDataFrame([("a", 1, "unavailable"), ("b", 2, "unavailable"), ("b", 1, "productive"), ("c", 1, "over limit"), ("d", 3, "productive"), ("d", 4, "unreliable")], "relay string, ended_at long, outcome string")
    assert {tuple(r) for r in state.learnt_capabilities(known, seen).collect()} == {("a", True), ("b", True), ("c", None), ("d", False), ("e", None)}
    marks = spark.createDataFrame([("a", 100), ("b", 500)], "relay string, dead_until long")
    failed = spark.createDataFrame([("c", 150), ("a", 120)], "relay string, failed_at long")
    assert {tuple(r) for r in state.dead_marks(marks, failed, 200, ttl_ms=60).collect()} == {("b", 500), ("c", 210)}
    assert state.dead_marks(marks, failed, 500, ttl_ms=60).count() == 0
    flat = spark.createDataFrame([(1, 5), (9, 5)], "at long, n long")
    assert state.rate_of(flat).first()["rate"] is None and state.rate_of(flat.limit(1)).first()["rate"] is None


def test_state_file_and_settings(spark, tmp_path, monkeypatch):
    f = stores.StateFile(spark, f"file://{tmp_path}/state.json")
    assert f.load(0) == {"dead_until": {}}
    f.save({"dead_until": {"a": 5, "b": 50}, "last": 1})
    f.save({"dead_until": {"a": 5, "b": 50}, "last": 2})
    assert f.load(5) == {"dead_until": {"b": 50}, "last": 2}
    (tmp_path / "env").write_text(stores.rendered_settings([("A", "1", "first"), ("B", "", "second")], {"A": "seven"}))
    assert stores.setting(spark, "A", f"file://{tmp_path}/env") == "seven" and stores.setting(spark, "C", f"file://{tmp_path}/env", "no") == "no"
    monkeypatch.setenv("A", "own")
    assert stores.setting(spark, "A", f"file://{tmp_path}/env") == "own"


#: Vectors of the signature scheme's published test data: key, message, signature, whether it holds.
VECTORS = [
    ("F9308A019258C31049344F85F89D5229B531C845836F99B08601F113BCE036F9", "00" * 32, "E907831F80848D1069A5371B402410364BDF1C5F8307B0084C55F1CE2DCA821525F66A4A85EA8B71E482A74F382D2CE5EBEEE8FDB2172F477DF4900D310536C0", True),
    ("DFF1D77F2A671C5F36183726DB2341BE58FEAE1DA2DECED843240F7B502BA659", "243F6A8885A308D313198A2E03707344A4093822299F31D0082EFA98EC4E6C89", "6896BD60EEAE296DB48A229FF71DFE071BDE413E6D43F917DC8DCF8C78DE33418906D11AC976ABCCB20B091292BFF4EA897EFCB639EA871CFA95F6DE339E4B0A", True),
    ("DFF1D77F2A671C5F36183726DB2341BE58FEAE1DA2DECED843240F7B502BA659", "243F6A8885A308D313198A2E03707344A4093822299F31D0082EFA98EC4E6C88", "6896BD60EEAE296DB48A229FF71DFE071BDE413E6D43F917DC8DCF8C78DE33418906D11AC976ABCCB20B091292BFF4EA897EFCB639EA871CFA95F6DE339E4B0A", False),
]


def test_signatures_in_batches():
    rows = [tuple(bytes.fromhex(x) for x in (m, k, s)) for k, m, s, _ in VECTORS]
    assert verify.signatures_hold(rows) == [v[3] for v in VECTORS] and verify.signatures_hold([]) == []
    many = []
    for i in range(300):
        message = hashlib.sha256(str(i).encode()).digest()
        many.append((message, *verify.signature(1000 + i % 7, message)))
    bad = dict.fromkeys((17, 200, 299))
    for i in bad:
        many[i] = (many[i][0], many[i][1], many[i][2][:63] + bytes([many[i][2][63] ^ 1]))
    many += [(b"", b"", b""), (many[0][0], b"\xff" * 32, many[0][2]), (many[0][0], many[0][1], b"\xff" * 64)]
    assert verify.signatures_hold(many) == [i not in bad for i in range(300)] + [False] * 3


def test_signatures_of_one_key_cost_little():
    import time

    many = [(m := hashlib.sha256(str(i).encode()).digest(), *verify.signature(1 + i % 5, m)) for i in range(400)]
    bad = {i: (many[i][0], many[i][1], many[i][2][:32] + many[i - 1][2][32:]) for i in range(20, 400, 40)}
    rows = [bad.get(i, row) for i, row in enumerate(many)]
    rows += [(b"", many[0][1], many[0][2]), (many[0][0], many[0][1], b"\xff" * 64), (many[0][0], many[0][1], many[0][2][:32] + bytes(32))]
    verify.generator_table()
    began = time.process_time()
    assert verify.signatures_hold(rows) == [i not in bad for i in range(400)] + [False] * 3
    assert (time.process_time() - began) / len(rows) < 0.003  # with one bad one in forty
    one = [many[0], many[1]]
    assert verify.signatures_hold(one) == [True, True]  # too few for tables


def test_signatures_are_checked_in_many_tasks(spark):
    """However few files the events are in."""
    rows = [((m := hashlib.sha256(str(i).encode()).digest()).hex(), "", i, 1, [], "", "") for i in range(50)]
    right = verify.only_verified(spark.createDataFrame(rows, EVENTS).coalesce(1))
    plan = right._jdf.queryExecution().executedPlan().toString().splitlines()
    at = lambda name: next(i for i, line in enumerate(plan) if name in line)
    assert at("ArrowEvalPython") < at("Exchange")


def test_a_signature_costs_little():
    import time

    many = [(m := hashlib.sha256(str(i).encode()).digest(), *verify.signature(5 + i, m)) for i in range(1000)]
    many[500] = (many[500][0], many[500][1], many[501][2])
    verify.generator_table()
    verify.with_even_y.cache_clear()
    began = time.process_time()
    assert sum(verify.signatures_hold(many)) == 999
    assert (time.process_time() - began) / len(many) < 0.006  # with one bad signature to find among a thousand
    began = time.process_time()
    assert all(verify.signatures_hold(many[:500]))
    assert (time.process_time() - began) / 500 < 0.002


def test_canonical_forms_and_ids(spark):
    import json

    texts = ['say "x"', "a\\b\n\r\t\b\f", "\x00\x01\x0b\x1f\x7f", "é 漢 \U0001f600", "", "</script>"]
    rows = [(i, f"p{i}", 7, 1, [["t", t], [], [t, "", t]], t) for i, t in enumerate(texts)]
    form = lambda p, at, k, tags, c: json.dumps([0, p, at, k, tags, c], ensure_ascii=False, separators=(",", ":"))
    good = [(hashlib.sha256(form(*r[1:]).encode()).hexdigest(), *r[1:]) for r in rows]
    bad = [("0" * 64, *rows[0][1:]), (None, *rows[1][1:]), (good[0][0], None, *rows[0][2:]), (good[0][0], "p0", 7, 1, None, texts[0]), (good[0][0], "p0", 7, 1, [None], texts[0])]
    e = log(spark, good + bad)
    assert ids(verify.only_verified(e, signatures=False)) == sorted(r[0] for r in good)
    assert ids(verify.only_verified(e)) == []
    null_in_tag = hashlib.sha256(form("p", 1, 1, [["t", None]], "").encode()).hexdigest()
    assert ids(verify.only_verified(log(spark, [(null_in_tag, "p", 1, 1, [["t", None]], "")]), signatures=False)) == [null_in_tag]


def test_signed_events(spark):
    rows = []
    for i in range(6):
        key, _ = verify.signature(i + 1, b"")
        said = f'[0,"{key.hex()}",{i},1,[],""]'
        digest = hashlib.sha256(said.encode()).digest()
        rows.append((digest.hex(), key.hex(), i, 1, [], "", (verify.signature(i + 1 if i != 3 else 9, digest)[1]).hex() if i < 5 else None))
    found = verify.only_verified(spark.createDataFrame(rows, EVENTS))
    assert sorted(r["created_at"] for r in found.collect()) == [0, 1, 2, 4]


def test_stream_into_store(spark, tmp_path):
    e = log(spark, [(f"e{i}", "x" if i % 2 else "y", i, 1, [], "") for i in range(6)])
    for part in (e.where("created_at < 4"), e.where("created_at > 2")):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.createDataFrame([("x",)], "pubkey string").write.parquet(f"{tmp_path}/enrolled")
    seen = []
    held = stores.EventStore(spark, f"file://{tmp_path}/events")
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    totals = streams.into_store(stream(), held, f"file://{tmp_path}/home", 100, hooks=(lambda b: seen.append(b.count()),))
    assert totals == {"received": 7, "stored": 6} and sum(seen) == 7 and held.events().count() == 6
    assert streams.into_store(stream(), held, f"file://{tmp_path}/home", 100) == {"received": 0, "stored": 0}
    assert streams.drained(stream(), each=streams.enrolled(f"{tmp_path}/enrolled")).select("pubkey").distinct().count() == 1
    calls = []
    done = streams.passes(lambda n: {"n": n} if n != 1 else 1 / 0, 3, lambda: calls.append("wait"), calls.append)
    assert done == [{"n": 0}, {"n": 2}] and calls == ["wait", "! pass 1 failed: division by zero", "wait"]


def test_load_harness(spark, tmp_path):
    held = stores.EventStore(spark, f"file://{tmp_path}/events")
    rows = spark.range(200).select("id", (F.col("id") % 5).alias("who"))
    report = stores.loaded(held, stores.generated_events(rows, "id", "who"), 10**10)
    assert (report["offered"], report["stored"]) == (200, 200)


def test_search_gates(spark):
    texts = spark.createDataFrame([("1", "a", "bitcoin and more"), ("2", "b", "bitcoins"), ("3", "c", "other")], "id string, author string, text string")
    trusted = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "author string, trust double")
    save = tables.saver(spark)
    found = lambda **k: ids(search.searched(texts, ["bitcoin"], trusted, 0.3, save, **k))
    assert found() == [] and found(spam=True) == ["1"] and found(spam=True, fuzzy=True) == ["1", "2"]
    assert search.searched(texts, ["bitcoin"], None, 0.0, save).count() == 0


def test_small_columns(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert [one(C.age(F.lit(x).cast("long"))) for x in (45_000, 200_000, 4_500_000)] == ["45s", "3m", "1h15m"]
    assert [one(C.coarse_duration(F.lit(x).cast("long"))) for x in (59, 3_700, 90_000)] == ["0m", "1h 1m", "1d 1h"]
    assert one(C.day_label(F.lit(None).cast("long"))) == "…" and one(C.day_label(F.lit(86_400 * 40).cast("long"))) == "02-10"
    assert one(C.busy_gauge(F.lit(0.0), F.lit(0.0), F.lit(0.0))) == "" and one(C.busy_gauge(F.lit(1.0), F.lit(0.5), F.lit(3.0))) == "vrf 1.0x wait 0.5x ins 100%"
