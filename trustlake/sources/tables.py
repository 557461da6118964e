"""Reading and writing: the driver's tables in the domain's terms, state tables, settings files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.schema import DELETION, FOLLOWS, INDEXER, NOTE, PROFILE, RELAY_LIST, SCORE, TRUST_LIST, VANISH
from trustlake.sources.commits import get_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in so many partitions that all cores have several, by ``keys`` if given: work that costs much a row should not follow the files it is read from."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in credit as services that their nation observes, hinted on the nation's region."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.where("s_acctbal >= 0").join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_nationkey").alias("observer"), F.col("s_suppkey").alias("service"), F.col("n_regionkey").alias("relay"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("service"), F.col("l_partkey").alias("subject"), F.col("l_quantity").alias("rank"), F.col("l_shipdate").alias("created_at"), "l_orderkey", "l_linenumber")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pubkey"), F.when(size % 5 == 0, 0).otherwise(size * 1000).alias("content_synced_at"), F.when(size % 10 == 0, 0).otherwise(size * 1000 + 1).alias("outbox_checked_at"))


def relay_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("author"), F.col("c_nationkey").alias("relay"), F.lit(0).alias("pos"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a tagged event log of twenty authors, as two stores would give it: every tenth event stands twice.

    Kinds follow the event's number, and tags and contents its ``k``: profiles, notes (some with subject, hashtags and
    places, some that expire), follows, deletions by id and by address, erasures, relay lists, trust lists, index relay
    lists, ephemeral events, lists by address, and scores, some without a rank or a subject. Some profiles and deletions
    had expired when they came.
    """
    k, n = F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_id")
    at = F.unix_date(F.to_date("ts")).cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    # an event's expressions cost far more than its bytes in a file show
    rows = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "props")).select("event_id", (F.col("user_id") % 20).alias("u"), at.alias("created_at"), k, (n % 16).alias("m"))
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    tag = lambda *parts: F.array(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    named = lambda i: F.lpad(i.cast("string"), 10, "0")
    u, k, m = F.col("u"), F.col("k"), F.col("m")
    kinds = {0: PROFILE, 3: FOLLOWS, 4: DELETION, 5: DELETION, 7: RELAY_LIST, 8: TRUST_LIST, 9: INDEXER, 10: 20001, 11: 30000, 12: SCORE, 13: SCORE, 15: SCORE}
    kind = F.when((m == 6) & (n % 160 == 6), VANISH)
    for number, value in kinds.items():
        kind = kind.when(m == number, value)
    expires = F.when(k % 8 == 0, NOW).otherwise(F.col("created_at") + (k - 50) * 43200)
    first = F.when(k % 4 == 0, c("ws://localhost:", k)).otherwise(c("wss://r", k % 7, ".example"))
    third = F.when(k % 2 == 0, F.lit("ws://192.168.1.1")).otherwise(c("wss://w", k % 3, ".example"))
    rank = F.when(k % 10 != 0, F.array(tag("rank", k.cast("string")))).otherwise(F.array().cast("array<array<string>>"))
    lapsed = F.when(n % 96 == 0, F.array(tag("expiration", "1"))).when(n % 80 == 4, F.array(tag("expiration", "1"))).otherwise(F.array().cast("array<array<string>>"))
    tags = {
        0: lapsed,
        2: F.array(tag("subject", c("subject w", k % 4)), tag("t", c("tag", k % 6)), tag("location", c("place ", k % 3)), tag("g", c("u4pr", k % 5))),
        4: F.concat(F.array(tag("e", named(n - k % 40))), lapsed),
        5: F.array(tag("a", c("30000:u", (u + F.when(k % 3 == 0, 1).otherwise(0)) % 20, ":", k % 5))),
        7: F.array(tag("r", first), tag("r", c("wss://read", k % 5, ".example"), "read"), tag("r", third, "write")),
        8: F.array(tag("30382:rank", c("u", k % 20), c("wss://r", k % 3, ".example")), tag("30382:followers", c("u", (k + 1) % 20), "wss://f.example"), tag("30382:rank", c("u", (k + 3) % 20))),
        9: F.when(k % 3 != 0, F.array(tag("relay", c("wss://i", k % 4, ".example")), tag("relay", "wss://i9.example"))).otherwise(F.array().cast("array<array<string>>")),
        11: F.array(tag("d", c("", k % 5)), tag("title", c("list w", k % 9)), tag("description", c("about w", k % 2))),
        14: F.array(tag("expiration", expires.cast("string"))),
    }
    score = F.concat(F.array(tag("d", F.when(k % 13 == 0, F.lit("")).otherwise(c("u", k % 20)))), rank)
    tagged = F.when(m.isin(12, 13, 15), score)
    for number, value in tags.items():
        tagged = tagged.when(m == number, value)
    profile = F.to_json(F.struct(c("name w", k % 7).alias("name"), F.when(k % 2 == 0, c("shown ", k % 3)).alias("display_name"), c("about w", k % 11).alias("about")))
    content = F.when(m == 0, profile).when(m.isin(1, 2, 6, 14), c("note w", k % 11, " on w", k % 5)).otherwise("")
    none = F.array().cast("array<array<string>>")
    log = rows.select(named(n).alias("id"), c("u", u).alias("pubkey"), "created_at", F.coalesce(kind, F.lit(NOTE)).alias("kind"), F.coalesce(tagged, none).alias("tags"), content.alias("content"), F.lit("").alias("sig"))
    return log.union(log.where(F.col("id").cast("long") % 10 == 0))


#: The clock of the queries over the event log, in epoch seconds.
NOW = 1_706_659_200


def shared_home(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``; where that is unset, below a temporary folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='trustlake-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saver(spark: SparkSession):
    """A function that writes a frame below ``spark.checkpoint.dir`` and reads it back."""

    def save(df: DataFrame) -> DataFrame:
        path = shared_home(spark, "saved")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return save


def insert_missing(store: DataFrame, seed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``seed`` whose keys the store lacks, for appending."""
    return seed.join(store.select(*keys).distinct(), keys, "left_anti")


def dotenv(spark: SparkSession, path: str) -> DataFrame:
    """key, value of a settings file: blank lines, comments and lines without ``=`` or key are skipped, quotes at both ends taken off; of a repeated key the last line counts."""
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    if path.rstrip("/").rsplit("/", 1)[-1].startswith((".", "_")):
        # Spark's readers pass over such names
        found = spark.createDataFrame([(path, get_text(spark, path) or "")], "file string, value string")
    else:
        found = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    texts = found.select("file", F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("pos", "raw"))
    lines = texts.select("file", "pos", bare(F.regexp_replace(bare("raw"), "^export ", "")).alias("line")).where("line <> '' and not startswith(line, '#') and contains(line, '=')")
    value = F.regexp_replace(bare(F.expr("substring(line, instr(line, '=') + 1)")), r"^['\"]+|['\"]+$", "")
    rows = lines.select(bare(F.substring_index("line", "=", 1)).alias("key"), value.alias("value"), F.struct("file", "pos").alias("place")).where("key <> ''")
    return rows.groupBy("key").agg(F.max_by("value", "place").alias("value"))


def settled(defaults: DataFrame, *sources: DataFrame) -> DataFrame:
    """key, value of every key with a default (key, value): from the first of ``sources`` that has the key, else the default."""
    out = defaults.select("key", F.col("value").alias("held"))
    for i, rows in enumerate(sources):
        out = out.join(rows.select("key", F.col("value").alias(f"from{i}"), F.lit(True).alias(f"has{i}")), "key", "left")
    found = F.col("held")
    for i in reversed(range(len(sources))):
        found = F.when(F.col(f"has{i}"), F.col(f"from{i}")).otherwise(found)
    return out.select("key", found.alias("value"))
