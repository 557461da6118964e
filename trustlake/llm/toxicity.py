"""Toxicity by a weighted lexicon: fold disguises, match by Aho-Corasick, take exceptions off, normalise by length."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import map_arrow, text_or_empty, written

#: Letters of other scripts, digits and signs that pass for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "z", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ӏ": "l", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "l", "!": "i", "+": "t"}

#: An entry's odds ratio of toxic to clean documents is above ``ODDS`` at a confidence of 95 % (``SURE`` deviations).
ODDS, SURE = 4.0, 1.645

_LETTERS = str.maketrans(LOOKALIKES)
_DIGITS = str.maketrans(DIGITS)
_DISGUISED = re.compile(r"[^\W\d_][0-9@$|!+]+(?=[^\W\d_])|(?<!\S)[0-9@$|]+(?=[^\W\d_]{2})")
_OTHER = re.compile(r"[^a-zß-ɏͰ-῿぀-퟿]+")
_MARKS = re.compile(r"[̀-ͯ​-‍­]+")


def fold(text: str) -> str:
    """The text's words in lower case between single spaces, look-alikes, accents, zero-width signs and digits in words undone."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower().translate(_LETTERS)
    else:
        text = text.lower()
    if _DISGUISED.search(text):
        text = _DISGUISED.sub(lambda m: m[0].translate(_DIGITS), text)
    return f" {_OTHER.sub(' ', text).strip()} "


class ToxicityModel(NamedTuple):
    """``lexicon``: weights of words (" word ") and beginnings of words (" beg"); ``exceptions``: phrases in which a hit does not count."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float
    by_sum: float
    by_density: float


def automaton(model: ToxicityModel):
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, w in model.lexicon.items():
        found.add_word(k, (len(k), w))
    for phrase in model.exceptions:
        found.add_word(fold(phrase), (len(fold(phrase)), None))
    if len(found):
        found.make_automaton()
    return found


def hits(found, folded: str) -> tuple[float, int]:
    """Sum of the weights and number of hits; at a word the heaviest entry counts, inside an exception none."""
    if not len(found):
        return 0.0, 0
    at: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, w) in found.iter(folded):
        start = end - n + 1
        if w is None:
            spared.append((start, end))
        elif w > at.get(start, 0.0):
            at[start] = w
    for a, b in spared:
        for s in [s for s in at if a <= s < b]:
            del at[s]
    return sum(at.values()), len(at)


def features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100.0 * total / max(words, 1))


def document_features(docs: DataFrame, model: ToxicityModel, extra: list[str]) -> DataFrame:
    """``extra`` columns with the two features of each whole text: x1, x2, and its hits."""
    state: dict = {}

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if "found" not in state:
            state["found"] = automaton(model)
        out = []
        for t in part.column("whole text").to_pylist():
            folded = fold(t)
            total, n = hits(state["found"], folded)
            out.append((*features(total, folded.count(" ") - 1), n))
        x = np.array(out, float).reshape(-1, 3)
        cols = {c: part.column(c) for c in extra}
        yield pa.RecordBatch.from_pydict(cols | {"x1": pa.array(x[:, 0]), "x2": pa.array(x[:, 1]), "hits": pa.array(x[:, 2].astype(np.int64))})

    kept = docs.select(*extra, text_or_empty().alias("whole text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in extra)
    return map_arrow(kept, run, f"{schema}, x1 double, x2 double, hits long", "whole text")


def entry_counts(sample: DataFrame, lengths: tuple[int, ...] = (4, 5, 6, 7)) -> DataFrame:
    """For each word and beginning of a word: in how many documents of each half and class it stands."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for t, y, half in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), part.column("half").to_pylist()):
            words = set(fold(t).split())
            entries = {f" {w} " for w in words if 2 < len(w) < 40}
            for n in lengths:
                entries.update(f" {w[:n]}" for w in words if len(w) > n)
            cell = 2 * half + y
            counts.update((e, cell) for e in entries)
        keys = list(counts)
        yield pa.RecordBatch.from_pydict({"entry": pa.array([k[0] for k in keys], pa.string()), "cell": pa.array([k[1] for k in keys], pa.int32()), "n": pa.array(list(counts.values()), pa.int64())})

    n = [F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(4)]
    return map_arrow(sample, run, "entry string, cell int, n long", "text").groupBy("entry").agg(*n)


def least_odds(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """Lower confidence bound of the log odds ratio of an entry that stands in so many of all toxic and clean documents."""
    cells = [F.greatest(x, F.lit(0)) + 0.5 for x in (toxic, F.lit(all_clean) - clean, clean, F.lit(all_toxic) - toxic)]
    return F.log(cells[0] * cells[1] / (cells[2] * cells[3])) - SURE * F.sqrt(sum((1 / x for x in cells[1:]), 1 / cells[0]))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, exceptions: tuple[str, ...] = ()) -> ToxicityModel:
    """A model from labelled documents: ``labels`` has doc_id and toxic (0 or 1), ``docs`` doc_id and text.

    About ``sample_rows`` labelled rows, chosen by a hash of doc_id, are read; this bounds what reaches the driver.
    The lexicon comes from different texts (toxic if any of its rows is): an entry must prove its toxicity in both halves of them,
    by a lower confidence bound on its odds that does not depend on the sample's size. Phrases in which an entry stands in clean
    documents only become exceptions, beside those given. Two features, the sum of the weights and the sum by length,
    then get a logistic fit. Without both classes the model scores everything 0.
    """
    spark = docs.sparkSession
    known = labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, sample_rows / max(known.count(), 1))
    chosen = known.where((F.xxhash64("doc_id", F.lit("sample")) % 1_000_000 + 1_000_000) % 1_000_000 < int(share * 1_000_000))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(chosen, "doc_id")
    sample = written(rows.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("half", F.abs(F.xxhash64("text") % 2).cast("int")), "toxic-sample")
    sizes = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    if not all(sum(sizes.get((h, y), 0) for h in (0, 1)) for y in (0, 1)):
        return ToxicityModel({}, exceptions, -20.0, 0.0, 0.0)
    clean, toxic = (sizes.get((0, y), 0) + sizes.get((1, y), 0) for y in (0, 1))
    seen = F.col("n1") + F.col("n3")
    weight = F.log((seen + 0.5) / (toxic + 1.0)) - F.log((F.col("n0") + F.col("n2") + 0.5) / (clean + 1.0))
    halves = [least_odds(F.col(f"n{2 * h + 1}"), F.col(f"n{2 * h}"), sizes.get((h, 1), 0), sizes.get((h, 0), 0)) > math.log(ODDS) for h in (0, 1)]
    best = entry_counts(sample).where(halves[0] & halves[1]).select("entry", weight.alias("weight")).where("weight > 2").orderBy("entry")
    lexicon = {r["entry"]: float(r["weight"]) for r in best.collect()}
    spared = clean_phrases(sample, lexicon) if lexicon else ()
    draft = ToxicityModel(lexicon, tuple(sorted({*exceptions, *spared})), 0.0, 0.0, 0.0)
    x = document_features(sample, draft, ["toxic"]).select("toxic", "x1", "x2").toPandas()
    return draft._replace(**fit(x[["x1", "x2"]].to_numpy(), x["toxic"].to_numpy(float)))


def clean_phrases(sample: DataFrame, lexicon: dict[str, float], least: int = 5) -> tuple[str, ...]:
    """Phrases of an entry's word and a neighbour that at least ``least`` clean documents have and no toxic one."""
    found = automaton(ToxicityModel(lexicon, (), 0.0, 0.0, 0.0))

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        phrases, classes = [], []
        for t, y in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
            folded, own = fold(t), set()
            for end, (n, _) in found.iter(folded):
                start = end - n + 1
                stop = folded.find(" ", start + 1)
                after, before = folded.find(" ", stop + 1), folded.rfind(" ", 0, max(start, 0))
                own |= {folded[start + 1 : after]} if after > 0 else set()
                own |= {folded[before + 1 : stop]} if before >= 0 and start > 0 else set()
            phrases += own
            classes += [y] * len(own)
        yield pa.RecordBatch.from_pydict({"phrase": pa.array(phrases, pa.string()), "toxic": pa.array(classes, pa.int32())})

    counted = map_arrow(sample, run, "phrase string, toxic int", "text").groupBy("phrase").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    return tuple(r["phrase"] for r in counted.where(f"bad = 0 and n >= {least}").orderBy(F.desc("n"), "phrase").collect())


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> dict[str, float]:
    """Logistic regression by Newton steps."""
    a, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"bias": float(w[0]), "by_sum": float(w[1]), "by_density": float(w[2])}


def scored(docs: DataFrame, model: ToxicityModel, extra: list[str]) -> DataFrame:
    """``extra`` columns of ``docs`` with ``score``, the chance of toxicity of each whole text, and ``hits``.

    A null or empty text has no hits and gets the score of a text without any. Repeated rows and nulls stay.
    """
    z = F.lit(model.bias) + F.lit(model.by_sum) * F.col("x1") + F.lit(model.by_density) * F.col("x2")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return document_features(docs, model, extra).select(*extra, score.alias("score"), "hits")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with their columns, that score below ``threshold``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    told = scored(docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")])), model, names)
    return told.where(F.col("score") < threshold).select(*names).toDF(*docs.columns)


def held_out():
    """Whether a row belongs to the fold that no model learns from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
