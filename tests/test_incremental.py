"""Tables in buckets and what is kept up to date in them: reputation, the text index, range fingerprints; and even assignment."""

import random

import pytest
from pyspark.sql import functions as F

from trustlake.operators import assignment, search
from trustlake.operators.index import TextIndex, variants
from trustlake.operators.ranges import LEVELS, RangeTree
from trustlake.operators.standing import Standing
from trustlake.sources import tables
from trustlake.sources.buckets import BucketedTable
from trustlake.sources.commits import CommitConflict


def test_a_change_goes_to_its_buckets(spark, tmp_path):
    t = BucketedTable(spark, f"file://{tmp_path}/t", "k string, v long", "k", buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    t.put(frame([(f"k{i}", i) for i in range(40)]), frame([(f"k{i}", i) for i in range(40)]))
    assert t.read().count() == 40
    t.put(frame([("k3", 0), ("gone", 0)]), frame([("k3", 30), ("k3", 31)]))
    assert len(t.touched["written"]) <= 2
    assert sorted(r["v"] for r in t.of(frame([("k3", 0), ("k4", 0)])).collect()) == [4, 30, 31] and len(t.touched["read"]) <= 2
    assert t.read().count() == 41 and t.of(frame([])).count() == 0

    def meanwhile(old):
        BucketedTable(spark, f"file://{tmp_path}/t", "k string, v long", "k").put(frame([("k9", 0)]), frame([]))
        return old

    with pytest.raises(CommitConflict):
        t.change({0, 1}, meanwhile)
    assert t.read().count() == 40


@pytest.mark.parametrize("seed", [3])
def test_standing_is_the_full_view_after_every_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    held = Standing(spark, f"file://{tmp_path}/s", tables.saver(spark), buckets=4)
    lists, scores = {}, {}
    for _ in range(4):
        changed = rng.sample([f"o{i}" for i in range(6)], 2)
        for o in changed:
            lists[o] = {f"s{rng.randrange(4)}" for _ in range(rng.randrange(3))}
        new = {(f"s{rng.randrange(4)}", f"p{rng.randrange(6)}"): rng.choice([None, *range(1, 90)]) for _ in range(10)}
        scores |= new
        held.apply(
            spark.createDataFrame([(o,) for o in changed], "observer string"),
            spark.createDataFrame([(o, s) for o in changed for s in lists[o]], "observer string, service string"),
            spark.createDataFrame([(*k, r) for k, r in new.items()], "service string, subject string, rank int"),
        )
        want = {}
        for o, services in lists.items():
            for (s, p), r in scores.items():
                if s in services and r is not None:
                    want[o, p] = max(r, want.get((o, p), 0))
        assert {(r["observer"], r["subject"]): r["rank"] for r in held.reputation().collect()} == want
    one = spark.createDataFrame([("o1",)], "observer string")
    assert {(r["subject"], r["rank"]) for r in held.reputation(one).collect()} == {(p, r) for (o, p), r in want.items() if o == "o1"}
    held.apply(one, spark.createDataFrame([], "observer string, service string"), spark.createDataFrame([], "service string, subject string, rank int"))
    assert held.cells.touched["written"] == held.cells.buckets_of(one) and held.by_subject.touched["written"] == set()
    assert held.reputation(one).count() == 0


def test_the_index_finds_what_the_scan_finds(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcd", k=rng.randint(4, 6))) for _ in range(30)]
    texts = [(str(i), f"a{i % 5}", i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12))), None if i % 7 == 0 else rng.choice(vocabulary)) for i in range(150)]
    df = spark.createDataFrame(texts, "id string, author string, created_at long, body string, title string")
    save = tables.saver(spark)
    held = TextIndex(spark, f"file://{tmp_path}/i", save, buckets=8)
    held.build(df, ["body", "title"])
    trusted = spark.createDataFrame([(f"a{i}", i / 5) for i in range(4)], "author string, trust double")
    tiers = {"body": 1.0, "title": 2.5}
    terms = [vocabulary[0], vocabulary[1], "absent"]
    near = next(w for w in vocabulary if len(w) >= 5)
    for kwargs in ({}, {"spam": True}, {"spam": True, "fuzzy": True}):
        asked = [near[:-1] + "x", *terms] if kwargs.get("fuzzy") else terms
        scan = search.searched(df.na.fill("", ["title"]), asked, trusted, 0.3, save, tiers, **kwargs)
        got = held.search(asked, tiers, trusted, 0.3, **kwargs)
        assert sorted(map(tuple, got.select("id", "author", "score").collect())) == sorted(map(tuple, scan.collect()))
    every = [tuple(r) for r in held.search(terms, tiers, trusted, spam=True).select("id", "score").collect()]
    assert [s for _, s in every] == sorted((s for _, s in every), reverse=True)
    assert [tuple(r) for r in held.search(terms, tiers, trusted, spam=True, limit=5).select("id", "score").collect()] == every[:5]
    assert held.postings.touched["read"] <= held.postings.buckets_of(spark.createDataFrame([(t,) for t in terms], "term string"))
    best = held.asked(f"{terms[0]} {terms[1]} sort:old include:spam", tiers, trusted, limit=3).collect()
    assert [r["created_at"] for r in best] == sorted(int(i) for i, _ in every)[:3]
    ranked = held.asked(f"{terms[0]} {terms[1]} filter:rank:50 sort:rank", tiers, trusted).collect()
    assert ranked and all(r["trust"] >= 0.5 for r in ranked) and [r["trust"] for r in ranked] == sorted((r["trust"] for r in ranked), reverse=True)
    assert held.search(terms, tiers, None).count() == 0 and held.search([], tiers, trusted).count() == 0
    assert held.search(["absent"], tiers, trusted, limit=3).count() == 0


def test_variants(spark):
    got = spark.createDataFrame([("abca",), ("",)], "w string").select(variants(F.col("w")).alias("v")).collect()
    assert set(got[0]["v"]) == {"abca", "bca", "aca", "aba", "abc"}


def test_ranges_tell_differences(spark, tmp_path):
    save = tables.saver(spark)
    base = spark.range(20_000).select(F.col("id").cast("string").alias("id"))
    one, two = (RangeTree(spark, f"file://{tmp_path}/{n}", save, buckets=16) for n in "ab")
    one.add(base)
    two.add(base.union(base.limit(5)))
    assert one.need_have(two).count() == 0 and one.compared == [16, 0, 0, 0]
    extra = spark.createDataFrame([("x1",), ("x2",), (None,)], "id string")
    two.add(extra)
    two.add(extra)
    one.remove(base.where("id in ('7', '19')").union(extra))
    two.remove(base.where("id = '100'"))
    assert {tuple(r) for r in one.need_have(two).collect()} == {("x1", "need"), ("x2", "need"), ("7", "need"), ("19", "need"), ("100", "have")}
    assert max(one.compared) <= 5 * 16 and one.compared[0] == 1 << LEVELS[0]
    again = RangeTree(spark, f"file://{tmp_path}/c", save, buckets=16)
    again.add(base.where("id not in ('7', '19')"))
    assert sorted(map(tuple, again.sums.read().collect())) == sorted(map(tuple, one.sums.read().collect()))


def least_load(lists):
    """The least possible greatest load, by augmenting paths for each capacity."""
    authors = sorted({a for a, _ in lists})
    for capacity in range(1, len(authors) + 1):
        at = {}

        def place(a, seen):
            for r in sorted({r for x, r in lists if x == a}):
                if r not in seen:
                    seen.add(r)
                    mine = [x for x, y in at.items() if y == r]
                    if len(mine) < capacity or any(place(x, seen) for x in mine):
                        at[a] = r
                        return True
            return False

        if all(place(a, set()) for a in authors):
            return capacity


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_are_even(spark, seed):
    rng = random.Random(seed)
    lists = {(f"a{i}", f"r{int(rng.random() ** 2 * 5)}") for i in range(40) for _ in range(rng.randint(1, 3))}
    rows = [*lists, *list(lists)[:5], (None, "r0"), ("a1", None)]
    found = assignment.balanced(spark.createDataFrame(rows, "author string, relay string"), tables.saver(spark)).collect()
    assert len(found) == 40 == len({r["author"] for r in found}) and all(tuple(r) in lists for r in found)
    loads = {r: sum(x["relay"] == r for x in found) for r in {x["relay"] for x in found}}
    assert max(loads.values()) < 2 * least_load(lists) or max(loads.values()) == least_load(lists)


def test_captive_authors_share_a_relay(spark):
    rows = [(f"a{i}", "only") for i in range(9)] + [("b", "only"), ("b", "other")]
    found = assignment.balanced(spark.createDataFrame(rows, "author string, relay string"), tables.saver(spark)).collect()
    assert len(found) == 10
    none = assignment.balanced(spark.createDataFrame([], "author string, relay string"), tables.saver(spark))
    assert none.count() == 0
