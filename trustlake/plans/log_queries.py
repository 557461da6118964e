"""Queries that run the event operators over a tagged event log, and those of a crawl's state."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustlake.functions import columns as C
from trustlake.functions import keys, verify
from trustlake.functions import places as P
from trustlake.operators import assignment, discovery, index, ranges, search, standing, state, store, trust
from trustlake.plans.queries import query
from trustlake.schema import DELETION, NOTE, RELAY_LIST, SCORE, TRUST_LIST, VANISH
from trustlake.sources import stores
from trustlake.sources import tables as S
from trustlake.sources.tables import NOW, table

SEEDS = [f"wss://i{i}.example" for i in (9, 5)]


def current(spark, d):
    return store.current_events(S.event_log(spark, d), NOW)


def stored_edges(spark, d):
    return trust.provider_edges(current(spark, d))


@query
def log_current_events(spark, d):
    return current(spark, d).select("id", "pubkey", "kind", "created_at")


@query
def log_visible_of_stored(spark, d):
    """By kind: how many ids a snapshot has, how many queries see, how many a sweep leaves."""
    held = store.stored_events(S.event_log(spark, d))
    seen = store.unexpired(held, NOW).select("id", F.lit(1).alias("seen"))
    return held.join(seen, "id", "left").groupBy("kind").agg(F.count("*").alias("stored"), F.count("seen").alias("visible"))


@query
def log_provider_edges(spark, d):
    return stored_edges(spark, d)


@query
def log_scores(spark, d):
    return trust.scores(current(spark, d)).select("service", "subject", "rank", "created_at")


@query
def log_reputation(spark, d):
    return trust.reputation(stored_edges(spark, d), trust.scores(current(spark, d)))


@query
def log_outboxes(spark, d):
    events = current(spark, d)
    index = spark.createDataFrame(list(enumerate(SEEDS)), "pos int, relay string")
    return discovery.outboxes(discovery.observers("u0", spark.createDataFrame([("u99",)], "observer string"), events), events, index)


@query
def log_index_relays(spark, d):
    """The index relays of some authors, one without any event among them: their newest list, or the seeds."""
    authors = spark.createDataFrame([(f"u{i}",) for i in (*range(20), 77)], "author string")
    return discovery.index_relays_of(authors, current(spark, d), SEEDS).select("author", "pos", "relay")


@query
def log_index_and_seeds(spark, d):
    e = current(spark, d)
    seeds = spark.createDataFrame(list(enumerate(SEEDS)), "pos int, relay string")
    return discovery.united(discovery.index_relays(e, "u1", SEEDS), seeds).select("relay", "rank.list", "rank.pos")


@query
def log_provider_relays(spark, d):
    return discovery.provider_relays(current(spark, d))


@query
def log_crawl(spark, d):
    """A whole pass over three replicas of the log: who is reached, and how many edges and scores come of it."""
    n = F.col("id").cast("long")
    relay = F.when(F.col("kind").isin(RELAY_LIST, TRUST_LIST), F.lit("idx")).when(F.col("kind") == SCORE, F.concat(F.lit("wss://r"), n % 3, F.lit(".example"))).otherwise("wss://else.example")
    replicas = S.saver(spark)(S.event_log(spark, d).where((F.col("kind") != DELETION) & (F.col("kind") != VANISH)).withColumn("relay", relay))
    found = discovery.crawl(replicas, "u0", ["idx"], S.shared_home(spark, "crawl"))
    part = lambda name, df: df.agg(F.lit(name).alias("what"), F.count("*").alias("n"))
    return part("observers", found["observers"]).union(part("edges", found["edges"])).union(part("scores", found["scores"])).union(part("deep", found["reached"].where("depth > 1")))


@query
def log_observers(spark, d):
    return discovery.observers("u0", spark.createDataFrame([("u99",), ("u3",)], "observer string"), current(spark, d))


@query
def log_absence_deletions(spark, d):
    """Scores that a service's only hinted relay no longer serves; relay r2 was listed in part, so it proves nothing, and some services lost too many."""
    events = S.saver(spark)(current(spark, d))
    held = trust.scores(events).select("id", "service")
    n = F.col("id").cast("long")
    lost = F.col("service").isin("u3", "u5", "u8") & (F.floor(n / 100) % 2 == 0)
    served = held.where((n % 7 != 0) & ~lost).select("id", F.explode(F.array(*[F.lit(f"wss://r{i}.example") for i in range(3)])).alias("relay"))
    listings = spark.createDataFrame([("wss://r0.example", True, False), ("wss://r1.example", True, False), ("wss://r2.example", False, False)], "relay string, complete boolean, capped boolean")
    homes = trust.single_relay_services(trust.provider_edges(events))
    return store.absence_deletions(held, served, homes, listings, S.saver(spark)).select("id", "service", "relay")


@query
def log_text_tiers(spark, d):
    return search.text_tiers(current(spark, d)).where("primary <> '' or secondary <> '' or body <> '' or location <> ''")


TERMS, TIERS = ["w3", "place"], {"primary": 3.0, "secondary": 2.0, "body": 1.0, "location": 0.5}


def indexed(spark, d):
    """The current events once, their texts in an index, and the reputation of the lists and scores among them."""
    events = S.saver(spark)(current(spark, d))
    texts = search.text_tiers(events).join(events.select("id", "created_at"), "id")
    held = index.TextIndex(spark, S.shared_home(spark, "index"), S.saver(spark), buckets=16)
    held.build(texts, list(TIERS))
    return held, S.saver(spark)(trust.reputation(trust.provider_edges(events), trust.scores(events)))


@query
def log_search_tiers(spark, d):
    """A search with extensions: trust of an observer's services, a least rank, all four tiers."""
    held, rep = indexed(spark, d)
    trusted = search.trust_of(spark.createDataFrame([("u1", 1.0), ("u2", 0.5)], "observer string, weight double"), rep)
    return held.asked("w3 place filter:rank:20 sort:rank", TIERS, trusted).select("id", "author", "score")


@query
def log_search_newest(spark, d):
    """The twenty newest hits, spam included, as ``sort:`` asks."""
    held, rep = indexed(spark, d)
    trusted = search.trust_of(spark.createDataFrame([("u1", 1.0)], "observer string, weight double"), rep)
    return held.asked("w3 place include:spam sort:new", TIERS, trusted, limit=20).select("id", "created_at", "score")


@query
def log_search_top(spark, d):
    """The fifteen best hits, found by bounds of blocks."""
    held, rep = indexed(spark, d)
    trusted = search.trust_of(spark.createDataFrame([("u1", 1.0), ("u2", 0.5)], "observer string, weight double"), rep)
    return held.asked("w3 place", TIERS, trusted, limit=15).select("id", "author", "score")


@query
def log_search_unknown_observer(spark, d):
    """How many hits each of three searchers gets: one who has named services, one whose services rank nobody, and one who is not known at all."""
    held, rep = indexed(spark, d)
    counts = []
    for who in ("u1", "u2", "nobody"):
        mine = rep.where(F.col("observer") == who)
        known = not mine.isEmpty()
        trusted = search.trust_of(spark.createDataFrame([(who, 1.0)], "observer string, weight double"), rep) if known else None
        counts.append(held.search(TERMS, TIERS, trusted).agg(F.lit(who).alias("who"), F.count("*").alias("n")))
    return counts[0].union(counts[1]).union(counts[2])


@query
def log_search_fuzzy(spark, d):
    """Words within one edit of a longer term count as it; spam included."""
    held, _ = indexed(spark, d)
    trusted = spark.createDataFrame([("u1", 0.5)], "author string, trust double")
    return held.search(["plase", "noted"], {"body": 1.0, "location": 1.0}, trusted, 0.3, spam=True, fuzzy=True).select("id", "author", "score")


@query
def log_standing(spark, d):
    """Reputation kept up to date over three batches of the log's lists and scores, the last of which takes some away."""
    events = S.saver(spark)(current(spark, d))
    edges, scored = trust.provider_edges(events).select("observer", "service").distinct(), trust.scores(events).select("service", "subject", "rank")
    held = standing.Standing(spark, S.shared_home(spark, "standing"), S.saver(spark), buckets=8)
    even = F.substring("observer", -1, 1).isin("0", "2", "4", "6", "8")
    first = F.pmod(F.crc32(F.concat("service", F.lit(":"), "subject")), F.lit(2)) == 0
    held.apply(edges.select("observer"), edges.where(F.substring("service", -1, 1) != "3"), scored.where(first))
    held.apply(edges.where(even).select("observer"), edges.where(even), scored.where(~first))
    held.apply(edges.where("observer = 'u1'").select("observer"), edges.limit(0), scored.where("subject = 'u7'").withColumn("rank", F.lit(None).cast("int")))
    return held.reputation()


@query
def search_extensions(spark, d):
    q = F.concat(F.lit("word "), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("filter:rank:"), F.col("p_size").cast("string"))).otherwise(""), F.lit(" sort:"), F.lower("p_type"), F.when(F.col("p_size") % 3 == 0, " include:spam").otherwise(" include:some"))
    p = table(spark, d, "part")
    return p.select("p_partkey", C.least_rank(q).alias("least"), C.search_extension(q, "sort").alias("sort"), C.includes_spam(q).alias("spam"))


@query
def content_kinds(spark, d):
    """How many of the log's events are of kinds that are fetched for scored authors."""
    return S.event_log(spark, d).where(F.col("kind").isin(*search.content_kinds())).groupBy("kind").agg(F.count_distinct("id").alias("n"))


@query
def log_geohash_cells(spark, d):
    return S.event_log(spark, d).dropDuplicates(["id"]).where(C.geohash_near(F.col("tags"), ["u4pr1", "u4pr4"])).select("id")


@query
def log_tag_index(spark, d):
    tags = S.event_log(spark, d).dropDuplicates(["id"]).select("kind", F.explode(C.tag_index(F.col("tags"))).alias("tag"))
    return tags.select("kind", F.split("tag", ":", 2)[0].alias("letter")).groupBy("kind", "letter").agg(F.count("*").alias("n"))


@query
def log_profiles(spark, d):
    e = current(spark, d).where("kind = 0")
    return e.select("pubkey", C.profile_field(F.col("content"), "name").alias("name"), C.profile_field(F.col("content"), "display_name").alias("display_name"))


@query
def log_expiring_notes(spark, d):
    """Notes by whether they ever expire, as a filter on what expires before a time."""
    e = store.stored_events(S.event_log(spark, d)).where(F.col("kind") == NOTE)
    return e.agg(F.count_if(F.col("expires_at") < NOW).alias("expired"), F.count_if(F.col("expires_at") == NOW).alias("now"), F.count_if(F.col("expires_at") > NOW).alias("later"))


@query
def log_insert_rules(spark, d):
    """How many events of each kind a store accepts of the log, given whole and then in part again."""
    log = S.event_log(spark, d)
    held = stores.EventStore(spark, S.shared_home(spark, "events"))
    held.insert(log, NOW)
    held.insert(log.where(F.col("id").cast("long") % 9 == 0), NOW)
    return store.current_events(held.events(), NOW).groupBy("kind").agg(F.count("*").alias("n"))


@query
def log_insert_fates(spark, d):
    """The history of two passes over a log, most of it and then all: what was offered, what became of it, what it replaced."""
    log, home = S.event_log(spark, d), S.shared_home(spark, "events")
    held, history = stores.EventStore(spark, home), stores.PassHistory(spark, f"{home}-passes")
    for number, part in ((1, log.where(F.col("id").cast("long") % 3 != 0)), (2, log)):
        history.append(number, NOW, [held.insert_reported(part, NOW)])
    return history.read().select("pass", "offered", "ephemeral", "expired", "duplicate", "known", "refused", "stored", "removed")


@query
def log_delete_by_filter(spark, d):
    held = stores.EventStore(spark, S.shared_home(spark, "events"))
    held.load(S.event_log(spark, d).dropDuplicates(["id"]))
    held.delete(F.col("kind") == SCORE, authors=["u7"])
    return held.events().groupBy("kind").agg(F.count("*").alias("n"))


@query
def ledger_snapshots(spark, d):
    """A ledger of two upserts, and the row of one author."""
    held = stores.StoredLedger(spark, S.shared_home(spark, "ledger"))
    rows = S.ledger(spark, d).withColumn("pubkey", F.col("pubkey").cast("string"))
    held.upsert(rows)
    held.upsert(rows.where("content_synced_at > 30000").select("pubkey", F.lit(5).cast("long").alias("content_synced_at"), F.lit(None).cast("long").alias("outbox_checked_at")))
    return held.read().groupBy("content_synced_at").agg(F.count("*").alias("n"), F.sum("outbox_checked_at").alias("checked"))


@query
def generated_load(spark, d):
    """An event for each order, in a store."""
    held = stores.EventStore(spark, S.shared_home(spark, "events"))
    held.load(stores.generated_events(table(spark, d, "orders"), "o_orderkey", "o_custkey"))
    return held.events().agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("pubkey").alias("authors"), F.max("created_at").alias("newest"))


def runs(spark, d):
    o = table(spark, d, "orders")
    return o.select((F.col("o_custkey") % 50).alias("relay"), F.col("o_orderpriority").alias("scope"), F.col("o_orderkey").cast("long").alias("ended_at"), (F.col("o_orderstatus") != "P").alias("completed"))


def scope_of(n):
    return F.element_at(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "5-LOW"))), (F.floor(n) % 3 + 1).cast("int"))


def cursors(spark, d):
    c = table(spark, d, "customer").select((F.col("c_custkey") % 60).alias("relay"), scope_of(F.col("c_custkey") / 60).alias("scope"), F.col("c_custkey").cast("long").alias("at"))
    return c.groupBy("relay", "scope").agg(F.max("at").alias("last_synced_at"))


@query
def cursor_advance(spark, d):
    return state.advanced_cursors(cursors(spark, d), runs(spark, d))


@query
def cursor_since(spark, d):
    filters = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 70).alias("relay"), scope_of(F.col("p_partkey") / 70).alias("scope"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("long")).alias("since"))
    return state.scoped(filters, cursors(spark, d), 30).select("p_partkey", "since", "first")


@query
def capability_memory(spark, d):
    n = F.col("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey")
    outcome = F.when(n % 4001 == 0, "unreliable").when(n % 5 == 1, "productive").when(n % 5 == 2, "unavailable").otherwise("over limit")
    seen = table(spark, d, "lineitem").select((F.col("l_suppkey") % 97).alias("relay"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ended_at"), outcome.alias("outcome"))
    known = table(spark, d, "supplier").where("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("relay"), F.when(F.col("s_suppkey") % 10 == 0, F.col("s_acctbal") > 4000).alias("capable"))
    return state.learnt_capabilities(known, seen)


@query
def dead_relays(spark, d):
    log = table(spark, d, "events")
    ms = (F.unix_date(F.to_date("ts")).cast("long") * 86400 + F.hour("ts") * 3600) * 1000
    failed = log.where("event_type = 'error'").select((F.col("user_id") % 40).alias("relay"), ms.alias("failed_at"))
    marks = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("relay"), F.lit(NOW * 1000 + 5).cast("long").alias("dead_until"))
    dead = state.dead_marks(marks, failed, (NOW - 86400) * 1000)
    every = log.select((F.col("user_id") % 60).alias("relay")).distinct()
    return every.join(dead, "relay", "left").select("relay", "dead_until").join(state.alive(every, dead, (NOW - 86400) * 1000).withColumn("alive", F.lit(True)), "relay", "left").withColumn("alive", F.coalesce("alive", F.lit(False)))


def readings(spark, d):
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("user_id").alias("n"))
    return days.select((F.unix_date("day").cast("long") * 86400).alias("at"), "n")


@query
def newest_readings(spark, d):
    return state.newest_readings(readings(spark, d))


@query
def readings_rate(spark, d):
    return state.rate_of(table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("at"), (F.col("o_orderkey") * 2 + F.col("o_custkey") % 2).cast("long").alias("n"))).select(F.round("rate", 9).alias("rate"))


@query
def pass_totals(spark, d):
    """A pass a day: received, new, and all received so far."""
    from pyspark.sql import Window

    by = table(spark, d, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("received"), F.count_distinct("user_id").alias("stored"))
    return by.withColumn("so_far", F.sum("received").over(Window.orderBy("day")))


@query
def completed_authors(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("author"), "o_orderstatus", "o_orderpriority")
    return state.completed_authors(o.where("o_orderpriority = '1-URGENT'"), o.where("o_orderstatus = 'F'")).groupBy("new").agg(F.count("*").alias("n"))


@query
def low_yield_discards(spark, d):
    o = table(spark, d, "orders")
    batches = o.select(F.col("o_custkey").alias("relay"), F.col("o_orderkey").alias("batch"), F.floor(F.col("o_totalprice") / 1000).cast("long").alias("downloaded"), F.when(F.col("o_orderkey") % 9 == 0, 0).otherwise(60).cast("long").alias("authors"))
    return state.low_yield_relays(batches, table(spark, d, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("relay")))


@query
def yield_per_author(spark, d):
    by = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("relay")).agg(F.count("*").alias("downloaded"), F.count_distinct("l_partkey").alias("authors"))
    return by.select("relay", F.expr("(downloaded * 7) div authors").alias("yield"))


@query
def slice_outcomes(spark, d):
    by = table(spark, d, "orders").groupBy((F.col("o_orderkey") % 8).alias("slice")).agg(F.count("*").alias("downloaded"), F.count_distinct("o_custkey").alias("stored"))
    return by.agg(F.sum("downloaded").alias("downloaded"), F.sum("stored").alias("stored"), F.count("*").alias("slices"))


@query
def work_position(spark, d):
    from pyspark.sql import Window

    every = Window.partitionBy("l_suppkey")
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    at = F.concat(F.row_number().over(every.orderBy("l_partkey")).cast("string"), F.lit("/"), F.count("*").over(every).cast("string"))
    return rows.select("l_suppkey", "l_partkey", at.alias("position"))


@query
def settled_downloads(spark, d):
    n, k = F.col("l_orderkey"), F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("relay"), F.col("l_partkey").alias("scope"), (k == 1).alias("pages_only"), F.when(n % 3 > 0, n % 3 == 1).alias("capable"), (k == 2).alias("capped"), (n % 7).alias("need"), (n % 5).alias("got"), (n % 2 == 0).alias("first"), (n % 11 != 0).alias("pages_completed"), (n % 13 != 0).alias("reconcile_completed"))
    return state.settled(rows).groupBy("transport", "completed").agg(F.count("*").alias("n"))


@query
def full_listings(spark, d):
    """The ids of the listings that are complete and without a limit."""
    ids = table(spark, d, "orders").select((F.col("o_custkey") % 30).alias("relay"), (F.col("o_orderkey") % 1000).alias("id"))
    relays = table(spark, d, "customer").select((F.col("c_custkey") % 35).alias("relay")).distinct()
    complete = relays.select("relay", (F.col("relay") % 3 != 0).alias("complete"), (F.col("relay") % 5 == 0).alias("capped"))
    return state.full_listing(ids, complete)


def author_relays(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("author")).agg(F.sort_array(F.collect_set(F.concat(F.lit("r"), F.col("o_orderkey") % 7))).alias("relays"))


@query
def relay_author_counts(spark, d):
    return author_relays(spark, d).select("author", F.explode("relays").alias("relay")).groupBy("relay").agg(F.count("*").alias("authors"))


@query
def observers_by_scores(spark, d):
    by = S.edges(spark, d).join(S.scores(spark, d), "service").groupBy("observer").agg(F.count("*").alias("n"))
    return by.orderBy(F.desc("n"), "observer")


@query
def routing_without_discarded(spark, d):
    lists = author_relays(spark, d).select(F.col("author").cast("string").alias("author"), F.posexplode(F.transform("relays", lambda r: F.concat(F.lit("wss://"), r, F.lit(".example")))).alias("pos", "relay"))
    authors = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("author"))
    routes = trust.routed(authors, lists, ["wss://f0.example"], discarded=spark.createDataFrame([("wss://r2.example",), ("wss://r5.example",)], "relay string"))
    return routes.groupBy("relay").agg(F.count("*").alias("n"))


@query
def least_loaded_relays(spark, d):
    lists = author_relays(spark, d).select("author", F.explode("relays").alias("relay"))
    return discovery.least_loaded(lists)


@query
def balanced_relays(spark, d):
    """Authors dealt evenly over their own relays: all have one, and no relay has twice the mean."""
    lists = author_relays(spark, d).select("author", F.explode("relays").alias("relay"))
    found = assignment.balanced(lists, S.saver(spark)).join(lists.withColumn("own", F.lit(True)), ["author", "relay"], "left")
    loads = found.groupBy("relay").agg(F.count("*").alias("load"), F.count("own").alias("own"))
    return loads.agg(F.sum("load").alias("authors"), F.sum("own").alias("own"), (F.max("load") < 2 * F.ceil(F.sum("load") / F.count("*"))).alias("even"))


@query
def need_have_ranges(spark, d):
    """What two stores of orders lack of each other, told by fingerprints of ranges that are kept while ids come and go."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus", "o_orderpriority")
    local, remote = (ranges.RangeTree(spark, S.shared_home(spark, "tree"), S.saver(spark), buckets=32) for _ in range(2))
    local.add(o)
    local.remove(o.where("o_orderstatus = 'P'"))
    remote.add(o.where("o_orderstatus <> 'P' or o_orderpriority = '1-URGENT'"))
    remote.remove(o.where("o_orderpriority = '5-LOW' and cast(id as long) % 100 = 0"))
    return local.need_have(remote)


@query
def identity_sources(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("author"))
    missing = c.withColumn("what", F.lit("profile")).union(c.where("author % 2 = 0").withColumn("what", F.lit("relay list")))
    first = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("author"), F.lit("profile").alias("what"))
    second = o.select(F.col("o_custkey").alias("author"), F.when(F.col("o_orderkey") % 2 == 0, "profile").otherwise("relay list").alias("what"))
    return discovery.identities(missing, first, second).groupBy("what", "source").agg(F.count("*").alias("n"))


@query
def work_map(spark, d):
    e = S.edges(spark, d).withColumn("relay", F.col("service") % 7)
    index = spark.createDataFrame([(0,), (9,)], "relay long")
    routes = table(spark, d, "customer").select((F.col("c_custkey") % 9).alias("relay"), F.col("c_custkey").alias("author"))
    return discovery.work_map(index, e, e.where("service % 2 = 0"), routes)


@query
def observer_dot_product(spark, d):
    rep = trust.reputation(S.edges(spark, d), S.scores(spark, d))
    weights = table(spark, d, "nation").where("n_regionkey < 2").select(F.col("n_nationkey").alias("observer"), (F.col("n_nationkey") % 3 * 0.5).alias("weight"))
    return search.trust_of(weights, rep).select("author", F.round("trust", 6).alias("trust"))


@query
def url_normalised(spark, d):
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("WSS://Relay"), F.col("page_id"), F.lit(".Example.com"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", C.normalised_url(url).alias("url"))


@query
def format_durations(spark, d):
    n = F.col("o_orderkey").cast("long") * 977
    return table(spark, d, "orders").select("o_orderkey", C.age(n * 10).alias("age"), C.coarse_duration(n).alias("eta"), C.thousands(n).alias("num"), C.percent(F.col("o_orderkey") % 97, F.col("o_orderkey") % 103).alias("pct"))


@query
def key_resolution(spark, d):
    """Keys in the forms people write: hexadecimal, as checked words, in profiles with hints, with spaces, in capitals; cut, damaged and mixed ones are none."""
    # words are read byte by byte, which a part's few bytes in a file do not show
    rows = S.spread(table(spark, d, "part").select("p_partkey")).select("p_partkey", F.sha2(F.col("p_partkey").cast("string"), 256).alias("key"))
    rows = rows.withColumn("word", keys.key_word(F.col("key")))
    hint = F.concat(F.lit("0106"), F.substring(F.col("key"), 1, 12))
    key, word, n = F.col("key"), F.col("word"), F.col("p_partkey") % 14
    record = F.concat(F.lit("0020"), key)
    records = F.element_at(F.array(F.concat(record, hint), F.concat(hint, record, hint), F.concat(hint, hint, hint, hint, hint), F.substring(F.concat(hint, record), 1, 82)), (n - 9).cast("int"))
    profile = keys.profile_word(records)
    at = (F.col("p_partkey") % 50 + 10).cast("int")
    damaged = F.concat(F.substring(word, 1, 62), F.when(F.substring(word, -1, 1) == "q", "p").otherwise("q"))
    swapped = F.concat(F.substring(word, F.lit(1), at - 1), F.when(F.substring(word, at, F.lit(1)) == "z", "x").otherwise("z"), F.substring(word, at + 1, F.lit(80)))
    forms = [F.concat(F.lit("  "), F.upper(key), F.lit(" ")), F.substring(key, 1, 63), F.concat(F.lit("g"), F.substring(key, 1, 63)), key, word, F.concat(F.lit(" "), F.upper(word)), damaged, swapped, F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 80)), F.concat(word, F.lit("q"))]
    text = F.when(n < 10, F.get(F.array(*forms), n.cast("int"))).otherwise(profile)
    return rows.select("p_partkey", text.alias("text")).select("p_partkey", keys.resolved_key(F.col("text")).alias("key"))


def places(spark, d):
    """Customers at places on the whole earth, poles and date line among them."""
    n = F.col("c_custkey").cast("long")
    lat = F.when(n % 50 == 0, 90.0).when(n % 50 == 1, -90.0).otherwise((n * 7919 % 180_001 - 90_000) / 1000.0)
    lon = F.when(n % 40 == 0, 180.0).when(n % 40 == 1, -180.0).otherwise((n * 104_729 % 360_001 - 180_000) / 1000.0)
    return table(spark, d, "customer").select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query
def place_cells(spark, d):
    """The cells of all precisions."""
    names = [P.cell(F.col("lat"), F.col("lon"), p).alias(f"p{p}") for p in range(1, 13)]
    return places(spark, d).select("c_custkey", *names)


@query
def place_cells_near(spark, d):
    """A place's cell and those around it, at a coarse and a finer precision."""
    near = lambda p: F.array_join(F.array_sort(P.cells_near(F.col("lat"), F.col("lon"), p)), " ")
    return places(spark, d).select("c_custkey", near(2).alias("near2"), near(5).alias("near5"))


LINES = ("=== phase 1 ===", "~ relays 4/9 | recv 3", "! host sync failed: x", "! host slow", "DONE - all", "[42/127] host  10040=1", "[state] saved", "a plain note", "  ! event dropped", "  [sync 2] +5")


@query
def log_line_classes(spark, d):
    line = F.element_at(F.array(*map(F.lit, LINES)), (F.col("o_orderkey") % len(LINES) + 1).cast("int"))
    return table(spark, d, "orders").groupBy(C.log_class(line).alias("what")).agg(F.count("*").alias("n"))


@query
def status_lines(spark, d):
    n = F.col("o_orderkey").cast("long")
    busy = C.busy_gauge(n % 3 / 2.0, n % 5 / 2.0, n % 4 * 0.25)
    return table(spark, d, "orders").select("o_orderkey", C.status_line(F.lit("relays"), n % 10, F.lit(10), n * 100, n % 2 * 1500, n * 10, busy).alias("line"))


@query
def capability_counts(spark, d):
    """How many relays can reconcile, cannot, and are not known to."""
    known = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") % 3 > 0, F.col("s_nationkey") % 3 == 1).alias("capable"))
    return known.agg(F.count_if("capable").alias("can"), F.count_if(~F.col("capable")).alias("cannot"), F.count_if(F.col("capable").isNull()).alias("unknown"))


@query
def ledger_counts(spark, d):
    return S.ledger(spark, d).agg(F.count("*").alias("n"), F.count_if(F.col("content_synced_at") > 0).alias("synced"), F.count_if(F.col("outbox_checked_at") > 0).alias("checked"))


@query
def verified_ids(spark, d):
    """Events whose id is the hash of what they say; every third has another one's."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("created_at"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("pubkey"), F.concat(F.lit("order "), F.col("o_orderpriority")).alias("content"))
    said = F.concat(F.lit('[0,"'), "pubkey", F.lit('",'), F.col("created_at") - (F.col("created_at") % 3 == 0).cast("int"), F.lit(',1,[],"'), "content", F.lit('"]'))
    e = o.select(F.sha2(said, 256).alias("id"), "pubkey", "created_at", F.lit(1).alias("kind"), F.array().cast("array<array<string>>").alias("tags"), "content", F.lit("").alias("sig"))
    return verify.only_verified(e, signatures=False).groupBy("content").agg(F.count("*").alias("n"))
