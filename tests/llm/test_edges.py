"""Very long texts, clashing names, repeated ids and empty tables, and the pipeline as a whole."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustlake.llm import flac, forest, mixing, ngram_join, queries, sentencepiece_codec, token_files, toxicity

INSIDE = ("query_id", "score", "rank", "ids", "leaf", "same", "salt", "r", "n", "size", "taken", "target", "key", "tid", "class_id", "x1", "x2", "hits", "payload", "media", "whole", "copy")


def clashing(df):
    for c in INSIDE:
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklé", k=rng.randint(1, 9))) for _ in range(3_000)]
    return " ".join(rng.choices(words, k=150_000)) + "\n" + "z" * 20_000


def test_long_text_in_token_files(spark, docs, long_text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    ids = [*Tokenizer.from_file(path).encode(long_text, add_special_tokens=False).ids, 1]
    got = {r["doc_id"]: r for r in token_files.token_files(docs([(1, "x", "s"), (2, long_text, "s"), (3, None, "s")]), path, 1, 49408).collect()}
    assert (got[2]["n_tokens"], got[2]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert got[3]["start"] == got[2]["start"] + len(ids) and got[3]["n_tokens"] == 1


def test_long_text_in_sentencepiece(spark, docs, long_text):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(long_text)
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode_documents(docs([(1, "x", "s"), (2, long_text, "s")]), path).collect()}
    assert list(got[2]["ids"]) == want and got[2]["parity"]


def test_long_text_in_toxicity(docs, long_text):
    model = toxicity.ToxicityModel({" dolt ": 3.0}, (), -2.0, 1.0, 0.5)
    got = {r["doc_id"]: r["hits"] for r in toxicity.scored(docs([(1, long_text + " d0lt", "s"), (2, long_text, "s"), (3, "a dolt", "s")]), model, ["doc_id"]).collect()}
    assert got == {1: 1, 2: 0, 3: 1}


def test_long_text_in_a_mix(docs, long_text):
    rows = [(1, long_text, "a"), *[(i, "one two three", "b") for i in range(2, 40)]]
    plan = {r["doc_id"]: r for r in mixing.mix_documents(docs(rows)).collect()}
    assert plan[1]["size"] == 150_001 and 0 < plan[1]["taken"] <= 2 * plan[1]["size"] and abs(plan[1]["taken"] - plan[1]["target"]) < 1


def test_long_text_in_flac(docs, long_text):
    raw = long_text.encode()
    padded = raw + bytes(-len(raw) % 64)
    got = {r["doc_id"]: r for r in flac.media_digests(flac.media_column(docs([(1, long_text, "s"), (2, "", "s")]))).collect()}
    assert (got[1]["n_bytes"], got[1]["payload_bytes"], got[1]["payload_sha256"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
    assert got[1]["tail_crc32"] == zlib.crc32(padded[-64:]) and got[2]["payload_bytes"] == 64


def test_clashing_names(spark, docs):
    rows = [(i, f"dolt {i}" if i % 4 == 0 else " ".join(f"w{i}{j}" for j in range(9)), f"s{i % 2}") for i in range(12)] + [(None, None, None), (12, "", "s0")]
    frame = clashing(docs(rows))
    model = toxicity.ToxicityModel({" dolt ": 9.0}, (), -2.0, 5.0, 5.0)
    left = toxicity.without_toxic(frame, model)
    assert left.columns == frame.columns and sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == [1, 2, 3, 5, 6, 7, 9, 10, 11, 12]
    kept = ngram_join.one_of_each_class(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} >= set(range(12))
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns and {r["taken"] for r in mixed.collect()} == {"x"}
    assert flac.media_digests(flac.media_column(frame)).count() == len(rows)
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(8)], "vec_id long, embedding array<float>")
    plain = sorted(map(tuple, forest.neighbours(vectors).collect()))
    assert plain == sorted(map(tuple, forest.neighbours(clashing(vectors)).collect())) and len(plain) == 5


def test_neighbours_of_ties_and_few(spark):
    rows = [(i, [1.0, 0.0]) for i in range(1, 7)] + [(0, [2.0, 0.0]), (0, [2.0, 0.0]), (100, [0.0, 3.0])]
    got = sorted(map(tuple, forest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert [(q, r, v) for q, r, v, _ in got] == [(0, r, r) for r in range(1, 6)] + [(100, r, r - 1) for r in range(1, 6)]
    assert [s for *_, s in got] == [1.0] * 5 + [0.0] * 5
    two = spark.createDataFrame([(0, [1.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in forest.neighbours(two).collect()] == [(0, 1, 3)]


def written_tables(spark, folder, rows, labels):
    rows.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_as_a_whole(spark, docs, tmp_path):
    """``run`` gives what the stages give one after another, with nulls, empty and equal rows, copies and repeated ids in the table."""
    import corpus_pipeline

    rng = random.Random(6)
    words = ["".join(rng.choices("klmnrstu", k=5)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(90)]
    rows = [(i, f"{t} stupid" if i % 3 == 0 else t, f"s{i % 3}") for i, t in enumerate(texts)]
    clean = [(i, t, s) for i, t, s in rows if i % 3]
    rows += [(200, clean[0][1], "s1"), (201, clean[1][1] + " more", "s2"), (clean[2][0], clean[3][1] + " other words", "s0"), (None, None, None), (None, texts[1] + " of none", None), (202, "", "s0"), (203, None, "s1")]
    frame = docs(rows).withColumn("taken", F.lit("x"))
    d = written_tables(spark, tmp_path / "in", frame, [(i, 1, int(i % 3 == 0)) for i in range(90)])
    got = sorted((r["doc_id"] or -1, list(r["ids"])) for r in corpus_pipeline.run(spark, d).collect())
    kept = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, d)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == frame.columns
            kept = spark.createDataFrame(kept.collect(), frame.schema)
    assert got == sorted((r["doc_id"] or -1, list(r["ids"])) for r in kept.collect())
    left = {i for i, _ in got}
    assert not left & {0, 3, 6, 200, 201, 202, 203} and len(left & {i for i, *_ in clean}) > 30


def test_pipeline_of_empty_tables(spark, docs, tmp_path):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, written_tables(spark, tmp_path / "none", docs([]), [])).count() == 0
    assert corpus_pipeline.run(spark, written_tables(spark, tmp_path / "blank", docs([(1, None, None), (None, "", "s")]), [(1, 0, 1)])).count() == 0
