"""The opN queries on the smallest tables: SQL where there is some, else their contract by brute force."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from trustlake.llm import flac, queries, toxicity

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    rows = lambda records, columns: sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in records), key=repr)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)


def test_op2(spark, documents):
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json")), 0
    got = sorted(queries.op2_token_files(spark, DIR).collect(), key=lambda r: r["start"])
    for r, d in zip(got, sorted(documents, key=lambda d: d["doc_id"]), strict=True):
        ids = [*tok.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (d["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op3(spark, documents):
    got = {r["doc_id"]: r for r in queries.op3_toxicity(spark, DIR).collect()}
    assert set(got) == {d["doc_id"] for d in documents}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_op3_scores_by_brute_force(spark, docs):
    model = toxicity.ToxicityModel({" dolt ": 3.0, " fool": 2.0}, ("dolt gate",), -2.0, 1.0, 0.5)
    texts = ["", None, "a dolt", "Fools and D0LTS", "the dolt gate is open", "a f00lish dolt " * 50]
    totals, words = [0, 0, 3, 2, 0, 250], [0, 0, 2, 3, 5, 150]
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs([(i, t, "s") for i, t in enumerate(texts)]), model, ["doc_id"]).collect()}
    for i, (total, n) in enumerate(zip(totals, words)):
        z = -2.0 + math.log1p(total) + 0.5 * math.log1p(100 * total / max(n, 1))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)))


def test_op4(spark, documents):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    want = {d["doc_id"]: own.encode(d["text"] or "") for d in documents}
    for r in queries.op4_sentencepiece(spark, DIR).collect():
        ids = want[r["doc_id"]]
        assert (r["n_tokens"], r["ids_crc32"], r["parity"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


def test_op5(spark, documents):
    counts = {}
    texts = {d["doc_id"]: (d["text"] or "").encode() for d in documents}
    for b in texts.values():
        for j in range(len(b) - 199):
            k = hash(b[j : j + 200])
            counts[k] = counts.get(k, 0) + 1
    for r in queries.op5_suffix_dedup(spark, DIR).collect():
        b = texts[r["doc_id"]]
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 199):
            if counts[hash(b[j : j + 200])] > 1:
                gone[j : j + 200] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert tuple(r) == (r["doc_id"], len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_op7(spark, documents):
    import re

    words = {d["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "") for d in documents}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][j : j + 13]), i)
    for r in queries.op7_substring_dedup(spark, DIR).collect():
        w = words[r["doc_id"]]
        stay = [True] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < r["doc_id"]:
                stay[j : j + 13] = [False] * 13
        kept = " ".join(x for x, s in zip(w, stay) if s).encode()
        assert tuple(r) == (r["doc_id"], len(w), stay.count(False), hashlib.sha256(kept).hexdigest())


def test_op8(spark):
    rows = [r for r in pq.read_table(f"{DIR}/embeddings.parquet").to_pylist() if r["embedding"] and None not in r["embedding"] and any(r["embedding"])]
    x = np.array([r["embedding"] for r in rows], float)
    ids, norms = np.array([r["vec_id"] for r in rows]), np.sqrt((x * x).sum(1))
    got, hit = queries.op8_forest(spark, DIR).collect(), 0
    for q in ids[ids % 50 == 0]:
        own = np.flatnonzero(ids == q)[0]
        s = x @ x[own] / (norms * norms[own])
        best = sorted((-s[i], ids[i]) for i in range(len(ids)) if i != own)[:5]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        for r in mine:
            assert r["score"] == pytest.approx(s[np.flatnonzero(ids == r["vec_id"])[0]], abs=1e-12)
        hit += len({r["vec_id"] for r in mine} & {i for _, i in best})
    assert hit >= 0.9 * len(got)


def test_op9(spark, documents):
    import re

    sets = {}
    for d in documents:
        w = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        sets[d["text"] or ""] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = {t: set() for t in sets}
    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and small >= 0.8 * large and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    text = {d["doc_id"]: d["text"] or "" for d in documents}
    for r in queries.op9_ngram_join(spark, DIR).collect():
        assert r["n_links"] == len(links[text[r["doc_id"]]])
        todo, seen = [text[r["doc_id"]]], set()
        while todo:
            t = todo.pop()
            if t not in seen:
                seen.add(t)
                todo += links[t]
        assert r["class_id"] == min(i for i, t in text.items() if t in seen)


def test_op10(spark, documents):
    got = {r["doc_id"]: r for r in queries.op10_flac(spark, DIR).collect()}
    for d in documents:
        b, r = (d["text"] or "").encode(), got[d["doc_id"]]
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        x = np.frombuffer(p, np.uint8).astype(np.int64) - 128
        (stream,) = flac.encode(np.frombuffer(p, np.uint8), np.array([0, len(p)]))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r["media_bytes"], r["media_sha256"], r["status"]) == (len(stream), hashlib.sha256(stream).hexdigest(), "ok")
        crossings, curve = int(((x[1:] >= 0) != (x[:-1] >= 0)).sum()), np.abs(x.reshape(-1, 64)).sum(1)
        assert r["feature"] == f"n={len(x)};peak={abs(x).max()};energy={(x * x).sum()};zero={crossings};curve={zlib.crc32(curve.astype('<i8').tobytes()):08x}"
