"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlake.llm import flac, forest, line_dedup, mixing, ngram_join, queries, sentencepiece_codec, substring_dedup, suffix_dedup, token_files, toxicity
from trustlake.llm.components import components
from trustlake.llm.shared_windows import Stretch, marked

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=40, vocabulary=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(vocabulary)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(n)]
    passage = " ".join(rng.choices(words, k=60))
    for i in range(0, n, 5):
        texts[i] += "\n" + passage
    near = texts[3].split(" ")
    texts += [texts[1], texts[2], " ".join([*near[:-1], "zz"]), "", "x" * 3000, "ab" * 900, "ab" * 901]
    return [(i, t, f"s{i % 3}") for i, t in enumerate(texts)] + [(7, texts[5], "s1"), (7, texts[5], "s1"), (None, texts[8], None), (900, None, "s0")]


def awkward(docs, rows):
    """With extra columns whose names the operators use inside."""
    df = docs(rows)
    for c in ("n", "gram", "start", "key", "tid", "size", "line", "pos", "packed", "label", "salt"):
        df = df.withColumn(c, F.lit("x"))
    return df


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    extra = [(50, "a~b ~ <|endoftext|>x. <|ENDOFTEXT|>", "s"), (51, "It's, don't. \"word.\", x.,y .. A. b.\n\nÀ é. ΣΑΣ. İ.", "s"), (52, "tab\tx.\r\ny,  z", "s")]
    rows = corpus(1) + extra
    want, at = [], 0
    for i, t in sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = token_files.token_files(awkward(docs, rows), path, 1, 49408)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    assert token_files.token_files(docs([]), path, 1, 49408).count() == 0


def test_sentencepiece(spark, docs):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = corpus(2) + [(60, "  two  spaces \n\n 漢字 \U0001f600 ▁mark", "s"), (61, " ", "s")]
    got = {(r["doc_id"], tuple(r["ids"]), r["decoded_ok"], r["parity"]) for r in sentencepiece_codec.encode_documents(awkward(docs, rows), path).collect()}
    assert {(i, k) for i, k, _, _ in got} == {(i, tuple(own.encode(t or ""))) for i, t, _ in rows}
    assert all(p for _, _, _, p in got) and all(d for i, _, d, _ in got if i != 60)


def test_mixing(spark, docs):
    rows = corpus(3)
    got = mixing.mix_documents(awkward(docs, rows)).collect()
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    taken = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        taken.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(t == int(target) for t, target in taken.values())
    assert sum(t for _, t in taken.values()) == pytest.approx(1.5 * sum(sizes.values()))
    mixed = mixing.mixed_documents(docs(rows)).groupBy("source").agg(F.sum(mixing.word_count()).alias("n")).collect()
    assert {r["source"]: r["n"] for r in mixed} == {s: t for s, (t, _) in taken.items() if t}
    assert mixing.mix_documents(docs([])).count() == 0


def test_flac(spark, docs):
    rows = corpus(4)
    got = flac.media_digests(flac.media_column(awkward(docs, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        texts = {(t or "").encode() for i, t, _ in rows if i == r["doc_id"]}
        pads = [b + bytes(max(64, -(-len(b) // 64) * 64) - len(b)) for b in texts]
        assert r["payload_sha256"] in [hashlib.sha256(p).hexdigest() for p in pads]
    blocks = flac.pcm_blocks(flac.media_column(docs(rows[:3]))).collect()
    assert all(b["sample_offset"] == b["block"] * flac.BLOCK for b in blocks)


def test_flac_frames_without_seek_table_and_damage():
    data = np.random.default_rng(0).integers(0, 256, 5056).astype(np.uint8)
    (stream,) = flac.encode(data, np.array([0, len(data)]))
    n = int.from_bytes(stream[43:46], "big")
    plain = b"fLaC\x80" + stream[5:42] + stream[46 + n :]
    assert (flac.decode([plain])[0][0] + 128 == data).all()
    with pytest.raises(ValueError):
        flac.decode([stream[:-40] + bytes([stream[-40] ^ 1]) + stream[-39:]])


def bits(*fields):
    n = value = 0
    for v, width in fields:
        value, n = value << width | v & (1 << width) - 1, n + width
    return (value << -n % 8).to_bytes((n + 7) // 8, "big")


def made_stream(frames, samples, channels, depth, block=4):
    info = bits((block, 16), (block, 16), (0, 24), (0, 24), (8000, 20), (channels - 1, 3), (depth - 1, 5), (samples, 36)) + bytes(16)
    out = b"fLaC\x80" + len(info).to_bytes(3, "big") + info
    for number, (size, assignment, subframes) in enumerate(frames):
        head = bytes([0xFF, 0xF8, 0x60, assignment << 4, number, size - 1])
        body = head + bytes([flac.crc8(head)]) + bits(*subframes)
        crc = 0
        for b in body:
            crc ^= b << 8
            for _ in range(8):
                crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
        out += body + crc.to_bytes(2, "big")
    return out


def test_flac_channels_and_wasted_bits():
    verbatim = lambda values, depth: [(0x02, 8), *((v, depth) for v in values)]
    left, right = [10, -20, 30, -40], [7, 7, 7, -7]
    side = [a - b for a, b in zip(left, right)]
    middle = [(a + b) >> 1 for a, b in zip(left, right)]
    frames = [(4, 1, verbatim(left, 16) + verbatim(right, 16)), (4, 8, verbatim(left, 16) + verbatim(side, 17)), (4, 9, verbatim(side, 17) + verbatim(right, 16)), (4, 10, verbatim(middle, 16) + verbatim(side, 17))]
    ((x, blocks),) = flac.decode([made_stream(frames, 16, 2, 16)])
    assert x.tolist() == [list(p) for p in zip(left, right)] * 4 and blocks == [(0, 4), (4, 4), (8, 4), (12, 4)]
    # two wasted bits: the values are held in 14 bits and stand for four times as much
    ((x, _),) = flac.decode([made_stream([(4, 0, [(0x03, 8), (1, 2), *((v, 14) for v in left)])], 4, 1, 16)])
    assert x.tolist() == [4 * v for v in left]


def test_flac_damaged_stream_spoils_no_other(spark):
    good = flac.encode(np.arange(128, dtype=np.uint8), np.array([0, 64, 128]))
    rows = [(1, 64, good[0]), (2, 64, good[1][:-9] + b"x" + good[1][-8:]), (3, 64, b"no stream"), (4, 64, None)]
    media = spark.createDataFrame([(i, n, None if m is None else bytearray(m)) for i, n, m in rows], "doc_id long, n_bytes long, media binary")
    got = {r["doc_id"]: r for r in flac.media_digests(media).collect()}
    assert set(got) == {1, 2, 3} and got[1]["status"] == "ok" and got[1]["payload_bytes"] == 64
    assert got[2]["status"].startswith("damaged") and got[2]["payload_sha256"] is None and got[3]["status"].startswith("damaged")
    blocks = {(r["doc_id"], r["status"][:7], r["n_samples"]) for r in flac.pcm_blocks(media).collect()}
    assert blocks == {(1, "ok", 64), (2, "damaged", None), (3, "damaged", None)}


@pytest.mark.parametrize("kind", ["unigram", "bpe"])
def test_sentencepiece_models_of_other_kinds(tmp_path, kind):
    # tokenizers are not trained here: a model file is put together from pieces
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type = 1 if kind == "unigram" else 2
    m.trainer_spec.byte_fallback = True
    m.normalizer_spec.remove_extra_whitespaces = True
    m.normalizer_spec.add_dummy_prefix = True
    m.normalizer_spec.escape_whitespaces = True
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{i:02X}>", 0, 6) for i in range(256))]
    pieces += [(p, -float(i), 1) for i, p in enumerate(["\u2581th", "the", "he", "\u2581the", "in", "ing", "\u2581", *"abcdefghijklmnopqrstuvwxyz"], 1)]
    for p, score, t in pieces:
        x = m.pieces.add()
        x.piece, x.score, x.type = p, score, t
    data = m.SerializeToString()
    own, codec = sentencepiece.SentencePieceProcessor(model_proto=data), sentencepiece_codec.Codec(data)
    texts = ["the thing", "  in  the   end ", "", "漢 the", "there", "\u2581the"]
    import pyarrow as pa

    ids, at, same = codec.encode(pa.array(texts))
    mine = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert not codec.alone and same.tolist() == [i == own.encode(t) for i, t in zip(mine, texts)]
    assert same.sum() >= 5


def test_empty_tables(spark, docs):
    none = docs([])
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    frames = [suffix_dedup.without_repeats(none), substring_dedup.without_copied_passages(none), ngram_join.similar_classes(none), ngram_join.one_of_each_class(none), sentencepiece_codec.encode_documents(none, queries.tokenizer_path("piece_bpe_32k.model")), flac.media_digests(flac.media_column(none)), flac.pcm_blocks(flac.media_column(none)), forest.neighbours(vectors), mixing.mixed_documents(none), components(spark.createDataFrame([], "u long, v long"))]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_long_texts(spark, docs, monkeypatch):
    from trustlake.llm import shared_windows

    monkeypatch.setattr(shared_windows, "LONG", 50_000)
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    passage = words(200)
    long = words(40_000) + " " + passage + " " + words(40_000)
    rows = [(1, long, "s"), (2, words(5) + " " + passage, "s"), (3, "x", "s"), (4, long[:-6] + "zzzzzz", "s")]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.without_repeats(docs(rows)).collect()}
    want = len(long) - 6
    assert got[3] == 0 and got[2] >= len(passage) and got[1] >= want and got[4] >= want
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.without_copied_passages(docs(rows)).collect()}
    assert got == {1: 0, 2: 200, 3: 0, 4: 80_199}
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.similar_classes(docs(rows)).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (3, 0), 4: (1, 1)}


def test_mixing_tells_sources_apart(docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (1, text, "b"), (1, text, "b"), (2, text, "a"), (None, text, None), (None, text, None)]
    plan = mixing.mix_documents(docs(rows)).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    mixed = mixing.mixed_documents(docs(rows)).groupBy("source").agg(F.sum(mixing.word_count()).alias("n")).collect()
    assert {r["source"]: r["n"] for r in mixed} == {r["source"]: r["n"] for r in plan} and 357 <= sum(r["n"] for r in plan) <= 360


def test_suffix_dedup(spark, docs):
    rows, n = corpus(5), 40
    counts = {}
    for _, t, _ in rows:
        b = (t or "").encode()
        for j in range(len(b) - n + 1):
            counts[b[j : j + n]] = counts.get(b[j : j + n], 0) + 1
    want = []
    for i, t, _ in rows:
        b = (t or "").encode()
        keep = np.ones(len(b), bool)
        for j in range(len(b) - n + 1):
            if counts[b[j : j + n]] > 1:
                keep[j : j + n] = False
        want.append((i, len(b), int((~keep).sum()), bytes(np.frombuffer(b, np.uint8)[keep])))
    got = [(r["doc_id"], r["n"], r["n_removed"], bytes(r["kept"])) for r in suffix_dedup.without_repeats(awkward(docs, rows), n).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [5000, 3])
def test_substring_dedup(spark, docs, monkeypatch, hot):
    from trustlake.llm import shared_windows

    monkeypatch.setattr(shared_windows, "HOT", hot)
    rows, n = corpus(6), 13
    first = {}
    for i, t, _ in rows:
        w, d = WORD.findall(t or ""), 1 << 62 if i is None else i
        for j in range(len(w) - n + 1):
            k = tuple(w[j : j + n])
            first[k] = min(first.get(k, d), d)
    want = []
    for i, t, _ in rows:
        w, d = WORD.findall(t or ""), 1 << 62 if i is None else i
        keep = [True] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < d:
                keep[j : j + n] = [False] * n
        want.append((i, len(w), keep.count(False), " ".join(x for x, k in zip(w, keep) if k).encode()))
    got = [(r["doc_id"], r["n"], r["n_removed"], bytes(r["kept"])) for r in substring_dedup.without_copied_passages(awkward(docs, rows), n).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_substring_dedup_splits_hot_grams_without_loss(spark, docs, monkeypatch):
    from trustlake.llm import shared_windows

    monkeypatch.setattr(shared_windows, "HOT", 3)
    rows = []
    for seed in range(60):
        rng = random.Random(seed)
        passage = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(13 + seed % 2)]
        for j in range(6):
            own = lambda k: ["".join(rng.choices("klmnop", k=8)) for _ in range(k)]
            # at a text's start, behind one word and behind several
            rows.append((len(rows), " ".join(own((0, 1, 4)[j % 3]) + passage + own(3)), "s"))
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.without_copied_passages(docs(rows), 13).collect()}
    assert got == {i: 0 if i % 6 == 0 else 13 + i // 6 % 2 for i, _, _ in rows}


def edits(a, b):
    if abs(len(a) - len(b)) > 1:
        return 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def lines_gone(rows):
    """(place in rows, position) of the lines that go, by comparing all with all."""
    places = [(n, p, x, (i is None, i or 0, p)) for n, (i, t, _) in enumerate(rows) if t is not None for p, x in enumerate(t.split("\n")) if WORD.search(x)]
    alike = lambda x, y: x == y or len(x) >= 16 and len(y) >= 16 and edits(x, y) <= 1
    return {(n, p) for n, p, x, at in places if any(before < at and alike(x, y) for _, _, y, before in places)}


def test_line_dedup(spark, docs, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(line_dedup, "FINE", 2)
    base = ["".join(rng.choices("abc ", k=rng.choice([5, 16, 17, 24, 70]))) for _ in range(12)]
    lines = []
    for _ in range(90):
        x = rng.choice(base)
        p, kind = rng.randrange(len(x)), rng.randrange(5)
        lines.append([x, x[:p] + x[p + 1 :], x[:p] + "é" + x[p:], x[:p] + "z" + x[p + 1 :], x[:p] + "zq" + x[p + 1 :]][kind])
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3]), "s") for i in range(30)] + [(31, None, "s"), (32, "", "s"), (33, " \n \n" + lines[0], "s"), (None, lines[4], "s")]
    gone = lines_gone(rows)
    got = {(r["doc_id"], p) for r in line_dedup.removed_lines(awkward(docs, rows)).collect() for p in r["removed"]}
    assert got == {(rows[n][0], p) for n, p in gone} and len(gone) > 20
    kept = {r["doc_id"]: r["text"] for r in line_dedup.without_duplicate_lines(awkward(docs, rows).withColumn("removed", F.lit(0))).collect()}
    for n, (i, t, _) in enumerate(rows):
        if t is not None:
            left = [x for p, x in enumerate(t.split("\n")) if (n, p) not in gone]
            assert kept.get(i) == ("\n".join(left) if left else None)
    assert line_dedup.removed_lines(docs([])).count() == 0 and line_dedup.without_duplicate_lines(docs([])).count() == 0


def test_line_dedup_long_lines(docs):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=1_000_000))
    rows = [(1, long, "s"), (2, long[:400_001] + "X" + long[400_002:], "s"), (3, long[:999_999], "s"), (4, long[:5] + "YY" + long[7:], "s"), (5, "Z" + long, "s")]
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.removed_lines(docs(rows)).collect()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_line_dedup_rows_of_one_doc_id(spark, docs):
    line = lambda x: f"line {x} " + x * 20
    rows = [(1, line("a"), "s"), (2, line("b") + "\n" + line("c"), "s"), (2, line("d") + "\n" + line("a"), "s")]
    rows += [(None, f"{line('e')}\n{line('a')}", "s"), (None, f"{line('f')}\n{line('g')}", "s"), (None, f"{line('f')}\n{line('g')}", "s"), (None, None, "s")]
    got = sorted((r["doc_id"] or 9, r["n_lines"], r["n_removed"], r["removed"], r["chars_removed"]) for r in line_dedup.removed_lines(awkward(docs, rows)).collect())
    assert got == [(1, 1, 0, [], 0), (2, 2, 0, [], 0), (2, 2, 1, [1], 27), (9, 0, 0, [], 0), (9, 2, 0, [], 0), (9, 2, 0, [], 0), (9, 2, 1, [1], 27)]
    kept = sorted(str(r["text"]) for r in line_dedup.without_duplicate_lines(docs(rows)).collect())
    assert kept == sorted([rows[0][1], rows[1][1], line("d"), line("e"), rows[4][1], rows[4][1], "None"])


def test_line_dedup_exact_repeats_of_short_lines(spark, docs):
    import corpus_pipeline

    rows = [(1, "Home\n\nNews", "s"), (2, "Home\n\n \nNew", "s"), (3, "Home", "s"), (4, "Homes\nHome\n", "s"), (None, "News\nHome\nx", "s")]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(docs(rows)).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: [1], None: [0, 1]}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs(rows), "").collect()}
    assert kept == {1: rows[0][1], 2: "\n \nNew", 4: "Homes\n", None: "x"}


def test_ngram_join_rows_of_one_doc_id(docs):
    words = lambda x: " ".join(f"{x}{i}" for i in range(60))
    rows = [(1, words("a"), "s"), (1, words("b"), "s"), (2, words("c"), "s"), (2, words("a"), "s")]
    rows += [(None, words("c"), "s"), (None, words("d"), "s"), (None, words("d"), "s"), (None, words("d") + " more", "s"), (None, words("e"), "s"), (None, words("a") + " more", "s")]
    kept = [(r["doc_id"], r["text"][0]) for r in ngram_join.one_of_each_class(awkward(docs, rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], key=repr)


def test_ngram_join(spark, docs):
    rows = corpus(8)
    sets = {}
    for _, t, _ in rows:
        w = WORD.findall(t or "")
        sets[t or ""] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = {a: {b for b in sets if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])} for a in sets}
    got = ngram_join.similar_classes(awkward(docs, rows)).collect()
    assert len(got) == len(rows)
    text = {hashlib.md5((t or "").encode()).digest(): t or "" for _, t, _ in rows}
    for r in got:
        own = text[bytes(r["tid"])]
        todo, seen = [own], set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += links[x]
        assert r["n_links"] == len(links[own])
        assert r["class_id"] == min((i for i, t, _ in rows if (t or "") in seen and i is not None), default=None)
    kept = ngram_join.one_of_each_class(docs(rows)).collect()
    assert len(kept) == len({r["class_id"] for r in got})


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20) if i != 11] + [(30, 31), (31, 30)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 if i <= 11 else 12 for i in range(21)} | {30: 30, 31: 30}


def test_forest(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[10:60] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (None, x[0].tolist())]
    got = forest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 900, 50):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and q not in [r["vec_id"] for r in mine]
        s = u @ u[q]
        s[q] = -2
        best = sorted(range(900), key=lambda i: (-round(s[i], 12), i))[:5]
        hit += len({r["vec_id"] for r in mine} & set(best))
        total += 5
    assert hit >= 0.9 * total and {r["query_id"] for r in got} == set(range(0, 900, 50))


def test_toxicity(spark, docs):
    assert toxicity.fold("Y0u ІD10T, idі0t! 2024 ok") == " you idiot idiot ok "
    rng = random.Random(1)
    clean = ["".join(rng.choices("klmnrstu", k=5)) for _ in range(50)]
    rows, labels = [], []
    for i in range(600):
        w = rng.choices(clean, k=rng.randint(5, 60))
        if i % 6 == 0:
            w[rng.randrange(len(w))] = rng.choice(["stupid", "idiot", "1di0t"])
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(i % 6 == 0)))
    frame = docs(rows + [(700, None, "s"), (701, "", "s")])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(frame.where(~toxicity.held_out()), known.where(~toxicity.held_out()))
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(frame, model, ["doc_id"]).collect()}
    wrong = [i for i, _, y in labels if (got[i] >= 0.7) != (y == 1)]
    assert len(wrong) <= 12 and got[700] < 0.5 and got[701] < 0.5
    assert toxicity.learn(docs([]), known).lexicon == {}
    own = toxicity.ToxicityModel({" clow": 2.0, " clown ": 3.0}, ("circus clown",), 0.0, 1.0, 1.0)
    found = toxicity.automaton(own)
    assert toxicity.hits(found, toxicity.fold("a clown, a CIRCUS cl0wn, clowns")) == (5.0, 2)


def test_toxicity_learns_rare_terms_from_many_labels(spark, docs):
    rng = random.Random(2)
    clean = ["".join(rng.choices("klmnrstu", k=5)) for _ in range(50)]
    texts = [" ".join(rng.choices(clean, k=12)) for _ in range(11_000)]
    texts = [f"{t} stupid{i % 5}" if i < 1_100 else t for i, t in enumerate(texts)]
    wanted = [(i, f"{texts[i]} dolt") for i in range(30)]
    half = {r["i"]: r["half"] for r in spark.createDataFrame(wanted, "i long, text string").select("i", F.abs(F.xxhash64("text") % 2).alias("half")).collect()}
    for h in (0, 1):
        for i in [i for i in half if half[i] == h][:4]:
            texts[i] += " dolt"
    known = spark.createDataFrame([(i, 1, int(i < 1_100)) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    assert " dolt " in toxicity.learn(docs([(i, t, "s") for i, t in enumerate(texts)]), known).lexicon


def within_one(x, y):
    if x == y:
        return True
    if abs(len(x) - len(y)) > 1:
        return False
    p = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    return x[p + 1 :] == y[p + 1 :] or x[p + 1 :] == y[p:] or x[p:] == y[p + 1 :]


def test_pipeline(spark):
    """Each stage on what the one before kept, by brute force."""
    import sentencepiece

    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs, rows = spark.read.parquet(f"{d}/documents.parquet"), None
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs.collect(), stage(spark, docs, d)
        rows = out.collect()
        text = {r["doc_id"]: r["text"] for r in before}
        if name != "SentencePiece":
            assert out.columns == columns
        if name == "toxicity":
            labels = spark.read.parquet(f"{d}/labels.parquet").where(~toxicity.held_out())
            model = toxicity.learn(docs.where(~toxicity.held_out()), labels)
            low = {r["doc_id"] for r in toxicity.scored(docs, model, ["doc_id"]).collect() if r["score"] < 0.7}
            assert {r["doc_id"] for r in rows} == low and low
        elif name == "line dedup":
            placed = [((i, p), x) for i in sorted(text) for p, x in enumerate((text[i] or "").split("\n")) if WORD.search(x)]
            gone, exact, near = set(), set(), []
            for at, x in placed:
                if x in exact or len(x) >= 16 and any(within_one(x, y) for y in near):
                    gone.add(at)
                exact.add(x)
                near += [x] * (len(x) >= 16)
            got = {r["doc_id"]: r["text"] for r in rows}
            for i, t in text.items():
                left = [x for p, x in enumerate((t or "").split("\n")) if (i, p) not in gone]
                assert got.get(i) == ("\n".join(left) if left else None)
            assert gone
        elif name == "n-gram Jaccard join":
            sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := WORD.findall(t or "")) else set() for i, t in text.items()}
            root = {i: i for i in sets}
            for i in sorted(sets):
                for j in sorted(sets):
                    if j < i and (text[i] == text[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                        old, new = max(root[i], root[j]), min(root[i], root[j])
                        root = {k: new if r == old else r for k, r in root.items()}
            assert {r["doc_id"] for r in rows} == set(root.values())
        elif name == "mixing":
            plan = {r["doc_id"]: r["taken"] for r in mixing.mix_documents(docs).collect()}
            taken = {}
            for r in rows:
                taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
                assert " ".join(WORD.findall(text[r["doc_id"]])).startswith(" ".join(WORD.findall(r["text"])))
            assert taken == {i: n for i, n in plan.items() if n}
        else:
            own = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
            key = lambda i, ids: (i, tuple(ids))
            assert sorted(key(r["doc_id"], r["ids"]) for r in rows) == sorted(key(r["doc_id"], own.encode(r["text"])) for r in before)
            assert all(r["parity"] for r in rows)
        docs = spark.createDataFrame(rows, out.schema)
    assert rows


def test_equal_seed_hashes_of_different_words(monkeypatch):
    """Windows whose seeds share a hash are told apart by their words."""
    monkeypatch.setattr(substring_dedup, "span_hash", lambda sums, a, b: np.zeros(len(a), np.uint64))
    words = [list(range(20)), list(range(100, 120)), [*range(50, 55), *range(100, 115)], list(range(3, 18))]
    rows = Stretch(*(np.array(c) for c in ([7] * 4, range(4), [True] * 4, [8, 8, 8, 3])), [np.array(w, np.uint64).tobytes() for w in words])
    assert substring_dedup.factors(13)(rows) == [(2, 5, 3), (3, 0, 3)]


@pytest.mark.parametrize("earlier", [False, True])
def test_stretches_that_share_one_of_two_hashes(spark, earlier):
    """Stretches are equal as wholes only where both hashes are; such of one hash alone are compared."""
    rows = [(1, 5, 6, 1), (1, 5, 7, 2), (1, 5, 6, 3), (2, 5, 6, 4), (3, 5, 6, 5), (3, 5, 6, 6), (4, 5, 6, 7), (4, 8, 6, 8)]
    placed = spark.createDataFrame([(g, a, b, d, 0, 0, 1, 0) for g, a, b, d in rows], "gram long, stretch long, other long, doc long, salt long, start int, windows int, owner int")
    got = {r["doc"]: (r["whole"], r["told"]) for r in marked(placed, earlier).collect()}
    assert {d for d, (whole, _) in got.items() if whole} == ({3, 6} if earlier else {1, 3, 5, 6})
    assert {d for d, (_, told) in got.items() if told} == {1, 2, 7, 8} and 4 not in got
