"""Nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample, deep enough for leaves of about ``LEAF`` vectors as far as the sample reaches;
every vector is then indexed in every tree. A query walks all trees through one priority queue ordered by how far it lies
on the wrong side of the splits passed, visits leaves until they hold enough vectors, and ranks what they hold exactly.
How much is enough is found on the sample: the least share of the vectors at which the sample's own neighbours are found
to the wanted recall. Neighbouring leaves form buckets of bounded size; a query is sent once to each bucket it visits,
with the leaves it visits there, and a bucket is copied only for every ``BLOCK_QUERIES`` queries that visit it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustlake.llm.common import written

#: Vectors of a leaf; of a bucket of leaves (fewer where vectors are long: bytes); queries that meet a bucket in one task.
LEAF, BUCKET, BUCKET_BYTES, BLOCK_QUERIES = 256, 20_000, 1 << 24, 2_000


class Tree(NamedTuple):
    """Splits in heap order: node i has the children 2i + 1 and 2i + 2, leaves follow the last split."""

    normals: np.ndarray
    cuts: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(int(math.log2(len(self.cuts) + 1))):
            right = np.einsum("ij,ij->i", x, self.normals[node]) > self.cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.cuts)


def fit_tree(x: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
    """Each split is the plane halfway in rank between the sides of two random points of its node."""
    splits = (1 << depth) - 1
    normals, cuts = np.zeros((splits, x.shape[1])), np.zeros(splits)
    members = {0: np.arange(len(x))}
    for node in range(splits):
        own = members.pop(node)
        if len(own) > 1:
            a, b = rng.choice(own, 2, replace=False)
            normal = x[a] - x[b]
            if not normal.any():
                normal = rng.standard_normal(x.shape[1])
        else:
            normal = rng.standard_normal(x.shape[1])
        normals[node] = normal / np.linalg.norm(normal)
        side = x[own] @ normals[node]
        cuts[node] = np.median(side) if len(own) else 0.0
        right = side > cuts[node]
        members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
    return Tree(normals, cuts)


def probes(trees: list[Tree], q: np.ndarray, sizes: list[np.ndarray], wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs for one query from the shared queue, nearest first, until they hold ``wanted`` vectors."""
    margins = [t.normals @ q - t.cuts for t in trees]
    queue = [(0.0, t, 0) for t in range(len(trees))]
    out, held = [], 0.0
    while queue and held < wanted:
        far, t, node = heapq.heappop(queue)
        splits = len(trees[t].cuts)
        while node < splits:
            right = margins[t][node] > 0
            heapq.heappush(queue, (max(far, abs(float(margins[t][node]))), t, 2 * node + 2 - right))
            node = 2 * node + 1 + right
        out.append((t, node - splits))
        held += sizes[t][node - splits]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def meeting(q: np.ndarray, x: np.ndarray, visits: dict[int, np.ndarray], leaf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs of visited leaves whose rounded cosine reaches the query's k-th best here, a superset of its k nearest.

    ``visits`` has the queries of each leaf, ``leaf`` is sorted.
    """
    q, x = unit(q), unit(x)
    who, what, how = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for own, asks in visits.items():
        a, b = np.searchsorted(leaf, (own, own + 1))
        if a == b:
            continue
        s = q[asks] @ x[a:b].T
        least = np.partition(s, b - a - k, axis=1)[:, b - a - k] - 1e-9 if b - a > k else np.full(len(s), -2.0)
        i, j = np.nonzero(s >= least[:, None])
        who.append(asks[i])
        what.append(a + j)
        how.append(s[i, j])
    who, what, how = np.concatenate(who), np.concatenate(what), np.concatenate(how)
    order = np.lexsort((-how, who))
    who, what, how = who[order], what[order], how[order]
    first = np.searchsorted(who, who, "left")
    kth = np.minimum(first + k - 1, np.searchsorted(who, who, "right") - 1)
    stay = how >= how[kth] - 1e-9
    return who[stay], what[stay]


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, each from its own two rows alone, so equal pairs give equal bits."""
    return (q * x).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1)))


class Forest(NamedTuple):
    trees: list[Tree]
    share: float


def fit_forest(x: np.ndarray, n: int, k: int, n_trees: int, recall: float, seed: int) -> Forest:
    """A forest for ``n`` vectors, fitted on the unit vectors ``x`` of them, and the share of all vectors that a query must look at for ``recall``.

    The share is measured on up to 200 of the rows against the others, with a margin of half the allowed miss.
    """
    rng = np.random.default_rng(seed)
    depth = max(0, min(math.ceil(math.log2(max(n, 1) / LEAF)), int(math.log2(max(len(x), 1) / 16))))
    trees = [fit_tree(x, depth, rng) for _ in range(n_trees)]
    if depth == 0:
        return Forest(trees[:1], 1.0)
    leaf = [t.leaves(x) for t in trees]
    sizes = [np.bincount(own, minlength=1 << depth) / len(x) for own in leaf]
    tries = rng.choice(len(x), min(200, len(x)), replace=False)
    reached = []
    for i in tries:
        s = x @ x[i]
        s[i] = -2
        best = np.argpartition(-s, k)[:k]
        held, first = 0.0, np.full(k, np.inf)
        for t, node in probes(trees, x[i], sizes, math.inf):
            held += sizes[t][node]
            first = np.minimum(first, np.where(leaf[t][best] == node, held, np.inf))
        reached.append(first)
    wanted = 1 - (1 - recall) / 2
    return Forest(trees, float(np.quantile(np.concatenate(reached), wanted)))


def dealt(total: list[np.ndarray], most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(first bucket, number of buckets) of each leaf of each tree: runs of neighbouring leaves of ``most`` vectors at most, or parts of one leaf."""
    bucket, parts, nth = [], [], 0
    for sizes in total:
        first, count, held = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0.0
        for leaf, n in enumerate(sizes.tolist()):
            if n and held + n > most and held:
                nth, held = nth + 1, 0.0
            first[leaf], count[leaf] = nth, math.ceil(n / most)
            if n > most:
                nth, held = nth + int(count[leaf]), 0.0
            else:
                held += n
        nth += 1
        bucket.append(first)
        parts.append(count)
    return bucket, parts


def neighbours(vectors: DataFrame, k: int = 5, query_every: int = 50, n_trees: int = 4, recall: float = 0.93, sample_rows: int = 20_000, seed: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each query by cosine, ties to the smaller vec_id.

    ``vectors`` has vec_id and embedding; queries are the rows whose vec_id is divisible by ``query_every``, candidates
    all rows but the query's own. Rows take no part whose vec_id or embedding is null, whose embedding is empty or
    holds a null or non-finite component, or is all zeros; vectors of another length than the most common one neither.
    Rows with one vec_id are one row. With fewer candidates than ``k`` all are returned; an empty table gives no rows.

    Equal vectors form one entry with its ``k + 1`` smallest ids, gathered in two steps over a salt, so a vector that a
    third of the rows share is ranked once. A leaf beyond ``BUCKET`` rows is dealt to several buckets by a hash. A bucket
    and a block of its queries meet in one task, which returns each query's best few only.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0))
    rows = written(valid.dropDuplicates(["vec_id"]), "vectors")
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    common = rows.groupBy(F.size("embedding").alias("wide")).count().orderBy(F.desc("count"), "wide").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wide, n = common["wide"], common["count"]
    rows = rows.where(F.size("embedding") == wide)
    # Equal vectors: the k + 1 smallest ids, first by salt, then together.
    near = F.xxhash64("embedding")
    salted = Window.partitionBy("same", "salt", "embedding").orderBy("vec_id")
    whole = Window.partitionBy("same", "embedding").orderBy("vec_id")
    few = rows.withColumn("same", near).withColumn("salt", F.xxhash64("vec_id") % 64).withColumn("r", F.row_number().over(salted)).where(f"r <= {k + 1}")
    few = few.withColumn("r", F.row_number().over(whole)).where(f"r <= {k + 1}")
    entries = written(few.groupBy("same", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    share = min(1.0, sample_rows / n)
    chosen = entries.where((F.xxhash64(F.element_at("ids", 1), F.lit(seed)) % 1_000_000 + 1_000_000) % 1_000_000 < int(math.ceil(share * 1_000_000)))
    x = np.array(chosen.select("embedding").toPandas()["embedding"].tolist(), float).reshape(-1, wide)
    forest = fit_forest(unit(x), n, k, n_trees, recall, seed)
    vector = rows.schema["embedding"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            u = unit(np.array(b["embedding"].tolist(), float).reshape(-1, wide))
            for t, tree in enumerate(forest.trees):
                yield pd.DataFrame({"tree": np.int32(t), "leaf": tree.leaves(u), "ids": b["ids"], "embedding": b["embedding"]})

    placed = written(entries.select("ids", "embedding").mapInPandas(place, f"tree int, leaf long, ids array<long>, embedding {vector}"), "leaves")
    total = [np.zeros(len(t.cuts) + 1) for t in forest.trees]
    for r in placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():  # at most as many rows as the forest has leaves
        total[r["tree"]][r["leaf"]] = r["n"]
    wanted = forest.share * float(total[0].sum())
    bucket, parts = dealt(total, max(LEAF, min(BUCKET, BUCKET_BYTES // (8 * wide))))
    queries = rows.where(F.col("vec_id") % query_every == 0)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), 500):
                part = b.iloc[start : start + 500]
                out = []
                for q, v in zip(part["vec_id"], part["embedding"]):
                    own: dict[int, list[int]] = {}
                    for t, leaf in probes(forest.trees, unit(np.asarray(v, float)[None])[0], total, wanted):
                        for i in range(parts[t][leaf]):
                            own.setdefault(int(bucket[t][leaf]) + i, []).append(leaf)
                    out += [(i, q, leaves, v) for i, leaves in own.items()]
                yield pd.DataFrame(out, columns=["bucket", "query_id", "leaves", "query"])

    asked = written(queries.select("vec_id", "embedding").mapInPandas(walk, f"bucket long, query_id long, leaves array<long>, query {vector}"), "walks")
    blocks = asked.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    where = [(t, leaf, int(bucket[t][leaf]), int(parts[t][leaf])) for t in range(len(total)) for leaf in range(len(total[t])) if parts[t][leaf]]
    homes = spark.createDataFrame(where, "tree int, leaf long, first long, parts int")
    keyed = placed.join(homes, ["tree", "leaf"]).withColumn("bucket", F.col("first") + F.pmod(F.xxhash64("ids"), "parts"))
    keyed = keyed.join(blocks, "bucket").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bucket", "block", "leaf", "ids", "embedding")
    asked = asked.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int"))

    def meet(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        right = right.sort_values("leaf", kind="stable")
        q, x = (np.array(c.tolist(), float).reshape(-1, wide) for c in (left["query"], right["embedding"]))
        asks: dict[int, list[int]] = {}
        for i, leaves in enumerate(left["leaves"]):
            for leaf in leaves:
                asks.setdefault(int(leaf), []).append(i)
        who, what = meeting(q, x, {leaf: np.array(i) for leaf, i in asks.items()}, right["leaf"].to_numpy(), k + 1)
        score = cosines(q[who], x[what])
        ids, own = right["ids"].to_numpy(), left["query_id"].tolist()
        found: dict[int, list[tuple[float, int]]] = {}
        for i, j, s in zip(who.tolist(), what.tolist(), score.tolist()):
            found.setdefault(i, []).extend((-s, c) for c in ids[j] if c != own[i])
        out = [(own[i], c, -s) for i, near in found.items() for s, c in heapq.nsmallest(k, near)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.groupBy("bucket", "block").cogroup(keyed.groupBy("bucket", "block")).applyInPandas(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
    return ranked.where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
