"""Queries of what runs between log and store: pages, batches that are tried again, enrolment, gauges, the run loop, settings; with their DuckDB SQL."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from trustlake.functions import verify
from trustlake.operators import state
from trustlake.operators.filters import EventFilter
from trustlake.plans.log_oracle import ARRIVED, LOG, stored
from trustlake.plans.queries import query
from trustlake.schema import EVENTS, NOTE
from trustlake.sources import stores
from trustlake.sources import tables as S
from trustlake.sources.tables import NOW, table
from trustlake.streaming import streams

#: Two weeks of the log, in epoch seconds.
SINCE, UNTIL = 1_704_672_000, 1_705_881_600


def halves(spark, d):
    """The log as two batches of a stream: the even ids, then the odd ones."""
    log = S.event_log(spark, d).withColumn("at", F.timestamp_micros(F.col("id").cast("long") % 2))
    path, files = streams.in_slices(spark, log, "at", 2)
    return streams.replica_stream(spark, path, EVENTS, EventFilter(), files=files)


@query
def stream_pages(spark, d):
    """The notes of two weeks that a replica gives page by page, by author."""
    home = S.shared_home(spark, "replica")
    S.event_log(spark, d).repartition(4, "id").write.parquet(home)
    pages = streams.replica_stream(spark, home, EVENTS, EventFilter(kinds=(NOTE,), since=SINCE, until=UNTIL))
    return streams.drained(pages).groupBy("pubkey").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query
def stream_store_resumed(spark, d):
    """A pass that dies in its second batch, goes on there and is reconciled with its replica: what is stored by kind, and how many rows were left for it to receive."""
    held, home, seen = stores.EventStore(spark, S.shared_home(spark, "events")), S.shared_home(spark, "pass"), []
    pages = halves(spark, d)

    def dies(batch):
        seen.append(batch)
        if len(seen) == 2:
            raise ConnectionError("the pass dies")

    try:
        streams.into_store(pages, held, home, NOW, hooks=(dies,))
    except StreamingQueryException:
        pass
    rest = streams.into_store(pages, held, home, NOW)
    streams.reconciled(held, S.event_log(spark, d), NOW)
    return held.events().groupBy("kind").agg(F.count("*").alias("n")).withColumn("resumed", F.lit(rest["received"]).cast("long"))


@query
def stream_enrolment(spark, d):
    """Events by author for whom ten authors stand enrolled at first, and five more from the second batch on."""
    enrolment = S.shared_home(spark, "enrolment")
    enrol = lambda numbers: spark.createDataFrame([(f"u{i}",) for i in numbers], "pubkey string").coalesce(1).write.mode("append").parquet(enrolment)
    enrol(range(10))
    got = streams.drained(halves(spark, d), each=streams.enrolled(enrolment), kept=lambda number: enrol(range(10, 15)) if number == 0 else None)
    return got.groupBy("pubkey").agg(F.count("*").alias("n"))


@query
def stream_gauges(spark, d):
    """Batches and rows that the gauges counted while the log was drained."""
    pages, gauges = halves(spark, d), streams.Gauges()
    spark.streams.addListener(gauges)
    try:
        streams.drained(pages)
        gauges.settle(spark)
    finally:
        spark.streams.removeListener(gauges)
    return spark.createDataFrame([(gauges.totals["batches"], gauges.totals["received"])], "batches long, received long")


@query
def run_loop(spark, d):
    """Four passes that each stamp a quarter of the ledger, the second of which fails: authors by stamp, failures, and the dead relays of the last state."""
    home, failures = S.shared_home(spark, "loop"), []
    ledger, remembered = stores.StoredLedger(spark, f"{home}/ledger"), stores.StateFile(spark, f"{home}/state.json")
    authors = S.ledger(spark, d).select(F.col("pubkey").cast("string").alias("pubkey"))

    def one(number):
        known = remembered.load(now_ms=number * 1000)
        if number == 1:
            raise ConnectionError("no relay answers")
        ledger.mark_synced(authors.where(F.col("pubkey").cast("long") % 4 == number), 100 + number)
        remembered.save(known | {"dead_until": known["dead_until"] | {f"r{number}": number * 1000 + 1500}})
        return {"pass": number}

    streams.passes(one, 4, lambda: None, failures.append)
    dead = ",".join(sorted(remembered.load(now_ms=3000)["dead_until"]))
    by = ledger.read().groupBy("content_synced_at").agg(F.count("*").alias("n"))
    return by.withColumn("failures", F.lit(len(failures)).cast("long")).withColumn("dead", F.lit(dead))


@query
def ledger_ports(spark, d):
    """What a ledger answers: one author's row, who was synced since a time, the stalest authors, who has an outbox."""
    ledger = stores.StoredLedger(spark, S.shared_home(spark, "ledger"))
    ledger.upsert(S.ledger(spark, d).withColumn("pubkey", F.col("pubkey").cast("string")))
    parts = {"row": ledger.get("7"), "synced": ledger.synced_since(40_000), "due": ledger.due_for_refresh(20_000, 25), "outbox": ledger.outbox_checked()}
    first, *others = [rows.select(F.lit(what).alias("what"), "pubkey") for what, rows in parts.items()]
    for rows in others:
        first = first.union(rows)
    return first


def settings(spark, d):
    """Settings of all parts as a file has them, some in quotes, some twice, some not at all."""
    key, value, n = F.concat(F.lit("K"), F.col("p_partkey")), F.col("p_type"), F.col("p_partkey") % 8
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    forms = [
        F.array(line("# ", value), line(key, "=", value)),
        F.array(line("\texport ", key, ' = "', value, '"')),
        F.array(line("# ", key, "=", value)),
        F.array(line(key, "='a=", value, "'  ")),
        F.array(key),
        F.array(F.lit(" "), line("=", value)),
        F.array(line(key, '="', value)),
        F.array(line(key, "=old"), line("export ", key, "=", value)),
    ]
    home = S.shared_home(spark, "settings")
    table(spark, d, "part").select(F.explode(F.get(F.array(*forms), n.cast("int"))).alias("line")).write.text(home)
    return S.dotenv(spark, home)


@query
def settings_file(spark, d):
    return settings(spark, d)


@query
def settings_chain(spark, d):
    """Each part's setting from the environment, else from the file, else its default."""
    parts = table(spark, d, "part").select(F.concat(F.lit("K"), F.col("p_partkey")).alias("key"), "p_size")
    environment = parts.where("p_size % 4 = 0").select("key", F.concat(F.lit("e"), F.col("p_size")).alias("value"))
    return S.settled(parts.select("key", F.lit("default").alias("value")), environment, settings(spark, d))


@query
def signed_notes(spark, d):
    """Notes of all customers in the names of fifty authors, some with the signature of another note, some with another text: what is verified of them."""
    n = F.col("c_custkey")
    notes = table(spark, d, "customer").select((n % 50 + 1).alias("secret"), n.cast("long").alias("created_at"), F.lit(NOTE).alias("kind"), F.array(F.array(F.lit("t"), F.col("c_mktsegment"))).alias("tags"), F.concat(F.lit("note "), F.col("c_name")).alias("content"))
    signed = verify.with_signatures(notes, "secret")
    other = F.concat(F.when(F.substring("sig", 1, 1) == "0", "1").otherwise("0"), F.substring("sig", 2, 127))
    changed = signed.withColumn("sig", F.when(F.col("created_at") % 40 == 3, other).otherwise(F.col("sig"))).withColumn("content", F.when(F.col("created_at") % 40 == 5, "another").otherwise(F.col("content")))
    return verify.only_verified(changed).groupBy("secret").agg(F.count("*").alias("n"), F.count_distinct("pubkey").alias("authors"))


@query
def newest_readings_rate(spark, d):
    """Growth a second over the newest twelve of all readings."""
    readings = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("at"), (F.col("o_orderkey") * F.col("o_orderkey") + F.col("o_custkey") % 2).cast("long").alias("n"))
    return state.rate_of(state.newest_readings(readings)).select(F.round("rate", 6).alias("rate"))


TWICE = f"{LOG}, twice AS (SELECT * FROM log UNION ALL SELECT * FROM log WHERE event_id % 10 = 0)"
SETTINGS = "f AS (SELECT 'K' || p_partkey AS key, CASE WHEN p_partkey % 8 = 3 THEN 'a=' ELSE '' END || p_type AS value FROM part WHERE p_partkey % 8 NOT IN (2, 4, 5))"
ORACLE = {
    "stream_pages": f"WITH {TWICE} SELECT pubkey, count(*) AS n, count(DISTINCT id) AS ids FROM twice WHERE kind = 1 AND created_at BETWEEN {SINCE} AND {UNTIL} GROUP BY 1",
    "stream_store_resumed": f"WITH {ARRIVED}, {stored('arrived', 'held')} SELECT kind, count(*) AS n, (SELECT count(*) FROM events WHERE event_id % 2 = 1) AS resumed FROM held GROUP BY 1",
    "stream_enrolment": f"WITH {TWICE} SELECT pubkey, count(*) AS n FROM twice WHERE CAST(pubkey[2:] AS INT) < 10 OR (CAST(pubkey[2:] AS INT) < 15 AND event_id % 2 = 1) GROUP BY 1",
    "stream_gauges": f"WITH {TWICE} SELECT 2::BIGINT AS batches, count(*) AS received FROM twice",
    "run_loop": "SELECT 100 + p_partkey % 4 AS content_synced_at, count(*) AS n, 1::BIGINT AS failures, 'r2,r3' AS dead FROM part WHERE p_partkey % 4 <> 1 GROUP BY 1",
    "ledger_ports": """WITH l AS (SELECT CAST(p_partkey AS VARCHAR) AS pubkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size * 1000 END AS synced, CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 1000 + 1 END AS outbox FROM part)
SELECT 'row' AS what, pubkey FROM l WHERE pubkey = '7' UNION ALL SELECT 'synced', pubkey FROM l WHERE synced >= 40000 UNION ALL SELECT 'outbox', pubkey FROM l WHERE outbox > 0
UNION ALL SELECT 'due', pubkey FROM (SELECT pubkey FROM l WHERE synced BETWEEN 1 AND 20000 ORDER BY synced, pubkey LIMIT 25)""",
    "settings_file": f"WITH {SETTINGS} SELECT * FROM f",
    "settings_chain": f"WITH {SETTINGS} SELECT p.key, CASE WHEN p_size % 4 = 0 THEN 'e' || p_size ELSE coalesce(f.value, 'default') END AS value FROM (SELECT 'K' || p_partkey AS key, p_size FROM part) p LEFT JOIN f USING (key)",
    "signed_notes": "SELECT c_custkey % 50 + 1 AS secret, count(*) AS n, 1::BIGINT AS authors FROM customer WHERE c_custkey % 40 NOT IN (3, 5) GROUP BY 1",
    "newest_readings_rate": "WITH n AS (SELECT o_orderkey AS k, o_orderkey * o_orderkey + o_custkey % 2 AS n FROM orders ORDER BY 1 DESC LIMIT 12) SELECT round((arg_max(n, k) - arg_min(n, k)) / (max(k) - min(k)), 6) AS rate FROM n",
}
