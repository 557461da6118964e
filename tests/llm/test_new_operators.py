"""SimHash groups, vector codes and spelling variants against brute force, with nulls, ties, repeats, long texts and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trustlake.llm import queries, simhash, spelling, vector_codes

CLASHING = ("fp", "cell", "n", "first", "least", "component_id", "word", "root", "form", "t", "k")


def with_clashes(df, names=CLASHING):
    for c in names:
        df = df.withColumn(c, F.lit("x"))
    return df


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(prints, ids):
    """The least id of each fingerprint's component."""
    todo, out = set(prints), {}
    while todo:
        group, queue = set(), [todo.pop()]
        while queue:
            a = queue.pop()
            group.add(a)
            near = {b for b in todo if (a ^ b).bit_count() <= 2}
            todo -= near
            queue += near
        known = [i for f, i in zip(prints, ids) if f in group and i is not None]
        out |= dict.fromkeys(group, min(known, default=None))
    return out


def test_simhash_against_brute_force(spark, docs):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcDEé", k=rng.randint(1, 6))) for _ in range(50)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(40)]
    long = " ".join(rng.choices(words, k=4000))
    texts += [long, long + " end", long.upper(), None, "", " \t\n", "One", "one", "ONE two", "x" * 5000, texts[3], "a b c d"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, texts[5], "s"), (3, texts[5], "s"), (None, texts[6], "s"), (None, "only null", "s")]
    got = sorted(map(tuple, simhash.near_duplicates(with_clashes(docs(rows))).collect()), key=repr)
    prints = [fingerprint(t) for _, t, _ in rows]
    least = reached(prints, [i for i, _, _ in rows])
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == sorted(((i, signed(f), least[f]) for (i, _, _), f in zip(rows, prints)), key=repr)
    assert simhash.near_duplicates(docs([])).count() == 0


def test_simhash_cells_are_never_broadcast(spark, monkeypatch):
    """Spark sizes an explode like the table it is made of."""
    frames, written = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: frames.append(df) or written(df, name))
    prints = spark.range(100).select((F.col("id") * 8).alias("fp"), F.col("id").alias("first"))
    links = simhash.near_fingerprints(written(prints, "prints"))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (*frames, links)]
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert {tuple(r) for r in links.collect()} == {(8 * u, 8 * v) for u in range(100) for v in range(u + 1, 100) if (u ^ v).bit_count() <= 2}


def test_simhash_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices(["alpha", "Beta", "γ", "d"], k=900))
    whole = simhash.fingerprint(text.encode()).tobytes()
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text.encode()).tobytes() == whole == fingerprint(text).to_bytes(8, "little")


@pytest.mark.parametrize("most", [256, 3])
def test_links_of_fingerprints(spark, monkeypatch, most):
    """Clusters round a few centres, with crowded cells split or not, have the components that all pairs give."""
    monkeypatch.setattr(simhash, "MOST", most)
    rng = random.Random(9)
    prints = {0, (1 << 64) - 1}
    for _ in range(4):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)}
        prints |= {centre ^ (x << 20) for x in range(32)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    links = simhash.near_fingerprints(spark.createDataFrame([(signed(f),) for f in prints], "fp long")).collect()
    assert all(((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= 2 and r["u"] != r["v"] for r in links)
    parent = {signed(f): signed(f) for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        parent[find(r["u"])] = find(r["v"])
    mine = Counter(find(signed(f)) for f in prints)
    want = Counter(reached(list(prints), list(prints)).values())
    assert sorted(mine.values()) == sorted(want.values())


def brute_codes(rows):
    """rows: (id, components, label) as kept."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in rows) // 16) * 16
    x = np.array([[*np.floor(256 * np.array(v, np.float64)), *[0] * (width - len(v))] for _, v, _ in ordered], np.int64).reshape(len(rows), 16, -1)
    book = x[:64].transpose(1, 0, 2).copy()
    at = lambda: np.stack([((x[:, p, None] - book[p]) ** 2).sum(2).argmin(1) for p in range(16)], 1)
    for _ in range(2):
        entry = at()
        for p in range(16):
            for e in range(book.shape[1]):
                if (mine := x[entry[:, p] == e, p]).size:
                    book[p, e] = mine.sum(0) // len(mine)
    entry = at()
    error = sum(((x[:, p] - book[p][entry[:, p]]) ** 2).sum(1) for p in range(16))
    return [(i, label, bytes(c.tolist()).hex(), int(e)) for (i, _, label), c, e in zip(ordered, entry, error)], book


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_vector_codes_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(vector_codes, "BLOCK", 32 * 50)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(70, 32))
    vectors = [(int(i), [float(x) for x in centres[i % 70] + spread * rng.normal(size=32)], [None, 1, 2][i % 3]) for i in rng.permutation(400)]
    vectors += [(5, vectors[0][1], 1), (5, vectors[1][1], 1), (None, vectors[2][1], None), (1000, [0.0] * 32, 2), (1001, [1.0] * 20, 1)]
    bad = [(2000, None, 1), (2001, [None] * 32, 1), (2002, [float("nan")] * 32, 1), (2003, [float("-inf")] + [0.0] * 31, 1)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>, label int")
    out = vector_codes.compressed(with_clashes(df, ("v", "code", "error", "rows", "entry", "of")))
    want, book = brute_codes(vectors)
    assert sorted(map(tuple, out.codes.collect()), key=repr) == sorted(want, key=repr)
    assert out.sha256 == hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    if spread < 1:
        assert max(out.rescanned) < 0.9  # parts whose bounds hold are not scanned again
    sums = {label: sum(e for _, x, _, e in want if x == label) for label in (None, 1, 2)}
    assert all(r["label_error"] == sums[r["label"]] for r in vector_codes.with_group_errors(out.codes).collect())


def test_vector_codes_of_few(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compressed(spark.createDataFrame([], schema)).codes.collect() == []
    one = vector_codes.compressed(spark.createDataFrame([(1, [0.5] * 16, None), (2, [0.5] * 16, None)], schema)).codes.collect()
    assert [(r["code"], r["error"]) for r in one] == [("00" * 16, 0)] * 2
    assert [r["code"] for r in vector_codes.compressed(spark.createDataFrame([(1, [], 3)], schema)).codes.collect()] == ["00" * 16]


def test_op12_on_the_tables(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.sql(queries.ORACLE["op12_vector_codes"])
    got = queries.op12_vector_codes(spark, "/root/testdata/sf0.01")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_op11_on_the_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = [fingerprint(r["text"]) for r in rows]
    least = reached(prints, [r["doc_id"] for r in rows])
    got = sorted(map(tuple, queries.op11_simhash(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted((r["doc_id"], f"{f:016x}", least[f]) for r, f in zip(rows, prints))


def brute_words(rows):
    counts = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: next((x for x in sorted(near[w], key=lambda x: (-n[x], x))[:1] if n[x] >= 2 * n[w]), None) for w in n}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def test_spelling_against_brute_force(spark, docs):
    rng = random.Random(2)
    stems = ["".join(rng.choices("abcéÿ×", k=rng.randint(4, 9))) for _ in range(12)]
    words = stems + [s[:i] + c + s[i + j :] for s in stems for i in range(len(s)) for j in (0, 1) for c in ("", "b", "É")]
    texts = [" ".join(rng.choices(words, k=300)) + ", " + stems[i % 12].upper() for i in range(40)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(40, None, "s"), (41, "", "s"), (42, "w" * 70_000 + " " + "w" * 69_999, "s"), (None, texts[0], "s"), (7, texts[7], "s"), (7, texts[7], "s")]
    rows += [(50 + i, "v" * 9000 + " " + "v" * 8999 + "x", "s") for i in range(3)]
    got = sorted(map(tuple, spelling.spelling_variants(with_clashes(docs(rows))).collect()), key=repr)
    assert got == brute_forms(brute_words([(i, t) for i, t, _ in rows]))
    assert spelling.spelling_variants(docs([])).collect() == []


@pytest.mark.parametrize(("words", "letters"), [(10_000, 1 << 18), (4, 1 << 18), (10_000, 20)])
def test_tries_split_by_prefixes(spark, words, letters):
    rng = random.Random(4)
    vocabulary = sorted({"".join(rng.choices("abc", k=rng.randint(5, 7))) for _ in range(250)} | {"aaaaa" + "".join(rng.choices("ab", k=4)) for _ in range(30)})
    df = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    got = sorted(map(tuple, spelling.near_words(df, words, letters).collect()))
    assert got == sorted((a, b) for a in vocabulary for b in vocabulary if one_edit(a, b))


def test_text_blocks_end_between_words(monkeypatch):
    text = "Ab, cÿd! " * 40
    monkeypatch.setattr(spelling, "BLOCK", 5)
    assert "".join(spelling.text_blocks(text)) == text
    assert [w for b in spelling.text_blocks(text) for w in spelling.RUN.findall(b)] == spelling.RUN.findall(text)


def test_roots_of_chains(spark):
    counts = spark.createDataFrame([("abcde" + "x" * i, 2**i) for i in range(12)], "word string, n long")
    got = {r["word"]: r["root"] for r in spelling.grouped(counts).collect()}
    assert set(got.values()) == {"abcde" + "x" * 11}
