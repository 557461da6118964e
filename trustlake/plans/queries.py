"""The report queries over the driver's tables. Each has DuckDB SQL of the same name in ``oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trustlake.functions import columns as C
from trustlake.operators import search, store, trust
from trustlake.operators.filters import EventFilter, by_many_keys, visible
from trustlake.sources import tables as S
from trustlake.sources.tables import table
from trustlake.streaming import streams

QUERIES: dict = {}
EVENT = {"id": "event_id", "pubkey": "user_id", "kind": "event_type", "created_at": "ts"}
NOW = "2024-01-31 00:00:00"


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def filter_kinds_authors_since(spark: SparkSession, d: str) -> DataFrame:
    kept = EventFilter(kinds=("click", "view"), authors=tuple(range(40)), since="2024-01-05", until="2024-01-25").predicate(EVENT)
    return table(spark, d, "events").where(kept).select("event_id", "user_id", "event_type", "ts", "value")


@query
def filter_tags_any_all(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, d, "events").withColumn("tag_index", F.array(F.concat(F.lit("k:"), k.cast("string")), F.concat(F.lit("t:"), F.col("event_type"))))
    return rows.where(EventFilter(tags={"k": (1, 2, 3, 5, 8, 13), "t": ("click", "purchase")}).predicate(EVENT)).select("event_id", k.alias("k"), "event_type")


@query
def filter_empty_list(spark, d):
    return table(spark, d, "events").where(EventFilter(authors=()).predicate(EVENT)).agg(F.count("*").alias("n"))


@query
def filter_newest_limit(spark, d):
    return EventFilter(kinds=("signup",), limit=25).scan(table(spark, d, "events"), EVENT).select("event_id", "ts")


@query
def filter_many_authors(spark, d):
    keys = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return by_many_keys(table(spark, d, "orders"), keys, "o_custkey").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query
def content_excluding_plumbing(spark, d):
    e = table(spark, d, "events").where(EventFilter(not_kinds=("error", "signup")).predicate(EVENT))
    return e.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("authors")).withColumn("per_author", F.when(F.col("authors") > 0, F.round(F.col("n") / F.col("authors"), 6)).otherwise(0.0))


@query
def expired_unswept(spark, d):
    """Expired but still stored, and what queries see; at its very time an event is hidden and not yet to be swept."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, d, "events").withColumn("expires_at", F.when(k % 4 == 0, F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(days=k)))
    now = F.lit(NOW).cast("timestamp_ntz")
    return e.groupBy("event_type").agg(F.count_if(EventFilter(expires_before=now).predicate()).alias("expired"), F.count_if(visible(F.col("expires_at"), now)).alias("visible"))


@query
def kind_histogram_top_other(spark, d):
    by = table(spark, d, "part").groupBy(F.col("p_type").alias("kind")).agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.orderBy(F.desc("n"), "kind"))
    ranked = by.withColumn("nth", nth)
    label = F.when(F.col("nth") <= 12, F.col("kind")).otherwise("other")
    return ranked.groupBy(label.alias("label")).agg(F.sum("n").cast("long").alias("n"), F.count("*").alias("kinds"))


@query
def supersede_replaceable(spark, d):
    return store.newest(table(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id", "ts")


@query
def supersede_addressable(spark, d):
    return store.newest(S.scores(spark, d), ["service", "subject"], "created_at", ["l_orderkey", "l_linenumber", "rank"]).select("service", "subject", "rank", "created_at")


@query
def rank_max_by_subject(spark, d):
    return S.scores(spark, d).where("rank is not null").groupBy("subject").agg(F.max("rank").alias("rank"))


@query
def services_single_relay(spark, d):
    return trust.single_relay_services(S.edges(spark, d))


@query
def orphan_scores(spark, d):
    return trust.orphans(S.scores(spark, d), S.edges(spark, d)).groupBy("service").agg(F.count("*").alias("n"))


@query
def scores_attributed_total(spark, d):
    known = S.edges(spark, d).select("service").distinct().withColumn("known", F.lit(True))
    rows = S.scores(spark, d).select("service").join(known, "service", "left")
    return rows.agg(F.count("*").alias("total"), F.count_if("known").alias("attributed")).withColumn("orphaned", F.col("total") - F.col("attributed"))


@query
def scores_per_observer(spark, d):
    edges = S.edges(spark, d)
    counts = edges.join(S.scores(spark, d), "service").groupBy("observer").agg(F.count("*").alias("n"))
    out = edges.select("observer").distinct().join(counts, "observer", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return out.where((F.col("n") > 0) | (F.col("observer") == 0))


@query
def observer_names(spark, d):
    n, region = table(spark, d, "nation"), F.col("n_regionkey")
    names = n.select(F.col("n_nationkey").alias("observer"), F.when(region == 1, "  ").when(region != 2, F.col("n_name")).alias("name"), F.when(region == 2, F.concat(F.lit("shown "), "n_name")).when(region == 1, F.col("n_name")).alias("display"))
    out = S.edges(spark, d).select("observer").distinct().join(names.where("observer % 7 <> 0"), "observer", "left")
    return out.select("observer", C.display_name(F.col("name"), F.col("display")).alias("name"))


@query
def observer_roster(spark, d):
    return trust.rosters(S.edges(spark, d), S.scores(spark, d))


@query
def observer_coverage(spark, d):
    return trust.coverage(S.edges(spark, d), S.scores(spark, d), S.relay_lists(spark, d), S.ledger(spark, d))


@query
def stale_ids_absence_delete(spark, d):
    held = S.scores(spark, d).select(F.struct("l_orderkey", "l_linenumber", "service", "subject").alias("id"), "service", (F.col("rank") > 5).alias("listed"))
    held = held.groupBy("id", "service").agg(F.bool_or("listed").alias("listed"))
    return store.guarded(held.withColumn("gone", ~F.col("listed")), S.saver(spark)).groupBy("service").agg(F.count("*").alias("n"))


@query
def need_have_diff(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "id")
    local, remote = o.where("o_orderstatus <> 'P'").select("id"), o.where("o_orderpriority <> '5-LOW'").select("id")
    return store.need_have(local, remote).groupBy("side").agg(F.count("*").alias("n"), F.sum("id").cast("long").alias("total"))


@query
def missing_identity(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    roster = o.select(F.col("o_custkey").alias("author")).union(c.select(F.col("c_custkey").alias("author"))).distinct()
    profile, lists = o.select(F.col("o_custkey").alias("author")).distinct(), c.where("c_acctbal > 0").select(F.col("c_custkey").alias("author"))
    part = lambda have, name: roster.join(have, "author", "left_anti").withColumn("missing", F.lit(name))
    return part(profile, "profile").union(part(lists, "relay list"))


@query
def content_routing(spark, d):
    authors = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("author"))
    lists = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").cast("string").alias("author"), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("ws://localhost:"), F.col("o_orderkey") % 7)).otherwise(F.concat(F.lit("wss://r"), F.col("o_orderkey") % 7, F.lit(".example"))).alias("relay")).distinct()
    lists = lists.withColumn("pos", F.row_number().over(Window.partitionBy("author").orderBy("relay")) - 1)
    return trust.routed(authors, lists, [f"wss://fallback{i}.example" for i in range(8)])


@query
def fallback_hash_spread(spark, d):
    return table(spark, d, "pages").select("page_id", (C.spread_hash("url") % 8).cast("long").alias("slot"))


@query
def popular_relays_top15(spark, d):
    index = spark.createDataFrame([(0,), (1,)], "relay int")
    by = S.relay_lists(spark, d).groupBy("relay").agg(F.count_distinct("author").alias("authors"))
    return by.join(F.broadcast(index), "relay", "left_anti").orderBy(F.desc("authors"), "relay").limit(15)


@query
def author_batches_500(spark, d):
    nth = F.row_number().over(Window.partitionBy("relay").orderBy("author"))
    rows = S.scores(spark, d).select((F.col("service") % 10).alias("relay"), F.col("subject").alias("author")).distinct()
    return rows.withColumn("batch", F.floor((nth - 1) / 500).cast("long")).groupBy("relay", "batch").agg(F.count("*").alias("n"), F.min("author").alias("first"), F.max("author").alias("last"))


@query
def refresh_slice(spark, d):
    return store.refresh_slice(S.ledger(spark, d), 20_000, 40).select("pubkey", "content_synced_at")


@query
def ttl_backlog_ranked(spark, d):
    fresh = S.ledger(spark, d).where("content_synced_at >= 30000").select(F.col("pubkey").alias("subject"))
    rank = S.scores(spark, d).groupBy("subject").agg(F.max("rank").alias("rank"))
    due = table(spark, d, "part").select(F.col("p_partkey").alias("subject")).join(fresh, "subject", "left_anti").join(rank, "subject", "left")
    return due.withColumn("rank", F.coalesce("rank", F.lit(0.0))).orderBy(F.desc("rank"), "subject")


@query
def ledger_upsert(spark, d):
    old = S.ledger(spark, d)
    new = old.where("content_synced_at > 30000").select("pubkey", F.lit(5).cast("long").alias("content_synced_at"), F.lit(None).cast("long").alias("outbox_checked_at"))
    return store.ledger_merge(old, new)


@query
def synced_rate_eta(spark, d):
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-11, 0)
    seen = F.count("*").over(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0))
    rows = table(spark, d, "events").withColumn("t", t).withColumn("count", seen)
    span, more = F.last("t").over(w) - F.first("t").over(w), F.last("count").over(w) - F.first("count").over(w)
    rows = rows.withColumn("rate", F.when(span > 0, more / span))
    return rows.select("event_id", F.round("rate", 9).alias("rate"), F.floor(F.lit(1000) / F.nullif(F.round("rate", 9), F.lit(0.0))).alias("eta"))


@query
def tick_rates(spark, d):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    by = table(spark, d, "events").groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    return by.withColumn("delta", F.col("n") - F.lag("n").over(Window.orderBy("day")))


@query
def low_yield_streak(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("relay"), F.col("o_orderkey").alias("batch"), (F.col("o_totalprice") < 100_000).alias("low"))
    w = Window.partitionBy("relay").orderBy("batch")
    rows = o.withColumn("island", F.sum((~F.col("low")).cast("int")).over(w))
    return rows.where("low").groupBy("relay", "island").agg(F.count("*").alias("streak")).where("streak >= 2").groupBy("relay").agg(F.max("streak").alias("streak"))


@query
def idle_gap_sessions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, d, "events").withColumn("before", F.lag("ts").over(w))
    new = (F.col("before").isNull() | (F.col("ts") > F.col("before") + F.expr("INTERVAL 30 MINUTES"))).cast("int")
    return rows.withColumn("new", new).groupBy("user_id").agg(F.sum("new").cast("long").alias("sessions"), F.count("*").alias("events"))


@query
def cursor_scope_keys(spark, d):
    key = C.scope_key(F.array(F.col("p_size")), F.when(F.col("p_partkey") % 2 == 0, F.array("p_partkey")).otherwise(F.array().cast("array<bigint>")))
    return table(spark, d, "part").select("p_partkey", key.alias("scope"), (F.col("p_partkey") * 100 - 3600).alias("since"))


@query
def incomplete_sync_flag(spark, d):
    q = F.col("l_quantity")
    flag = C.looks_incomplete(F.col("l_returnflag") != "N", F.col("l_linenumber") == 7, q, q * 0 + 25, F.col("l_linestatus") == "F")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_if(flag).alias("incomplete"), F.count("*").alias("n"))


@query
def url_authority_path(spark, d):
    return table(spark, d, "pages").select("page_id", C.authority(F.col("url")).alias("authority"), C.path(F.col("url")).alias("path"))


HOSTS = ("10.0.1.24:4848", "localhost:1", "100.103.119.73", "x.onion", "172.16.5.5", "13.50.72.62", "10up.io", "127.example.com", "0.1.2.3", "172.32.0.1", "a.local", "127.0.0.1", "100.128.0.1", "192.168.7.7:80", "169.254.1.1", "192.169.0.1")


@query
def url_publicly_routable(spark, d):
    p, hosts = table(spark, d, "pages"), F.array(*map(F.lit, HOSTS))
    local = F.concat(F.lit("wss://"), F.element_at(hosts, (F.col("page_id") % len(HOSTS) + 1).cast("int")), F.lit("/x"))
    return p.select("page_id", C.routable(local).alias("local"), C.routable(F.col("url")).alias("own"))


@query
def url_collapse(spark, d):
    """Each url's shortest path on its host that is another page's too: a path's own prefixes are listed and looked up."""
    p = table(spark, d, "pages").select("page_id", C.authority(F.col("url")).alias("authority"), F.split(C.path(F.col("url")), r"\?")[0].alias("path"))
    parts = F.split("path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    short = p.select("authority", F.col("path").alias("prefix")).distinct()
    both = p.select("page_id", "authority", F.explode(prefixes).alias("prefix")).join(short, ["authority", "prefix"])
    return both.groupBy("page_id").agg(F.min_by("prefix", F.struct(F.length("prefix"), "prefix")).alias("kept"))


@query
def format_compact(spark, d):
    n = F.col("o_orderkey") * 137
    return table(spark, d, "orders").select("o_orderkey", C.compact(n).alias("text"))


@query
def format_age_ago(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.ago(F.lit(1_000_000).cast("long"), 1_000_000 - F.col("o_orderkey") * 29).alias("text"))


@query
def kind_labels(spark, d):
    names = F.create_map(*[F.lit(x) for x in ("view", "views", "click", "clicks", "error", "errors")])
    by = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return by.select("event_type", F.coalesce(F.try_element_at(names, "event_type"), F.concat(F.lit("kind "), F.col("event_type"))).alias("label"), "n")


@query
def config_list_parse(spark, d):
    text = F.concat_ws(",", "p_brand", F.lit(" "), "p_type", F.lit(""))
    return table(spark, d, "part").select("p_partkey", F.array_join(C.config_list(text), "|").alias("items"), C.config_int(F.col("p_size").cast("string"), 128, 5).alias("width"))


@query
def search_strip_extensions(spark, d):
    q = F.concat(F.lower("p_type"), F.lit(" language:en "), F.lit("filter:rank:30"))
    return table(spark, d, "part").select("p_partkey", F.array_join(C.search_terms(q), " ").alias("terms"))


@query
def search_raw_count(spark, d):
    words = F.split(F.lower("text"), r"[^\p{L}]+")
    return table(spark, d, "documents").where(F.array_contains(words, "the")).groupBy("lang").agg(F.count("*").alias("n"))


@query
def search_bm25_trust(spark, d):
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("author"), "text")
    trusted = texts.select("author").distinct().select("author", ((F.length("author") * 7 + F.ascii(F.substring("author", 4, 1))) % 10 / 10.0).cast("double").alias("trust"))
    return search.searched(texts, ["the", "idiot", "von"], trusted, 0.3, S.saver(spark), letters=r"[^\p{L}]+").orderBy(F.desc("score"), "id").limit(500)


@query
def delete_explicit(spark, d):
    e = table(spark, d, "events")
    asked = e.where("event_type = 'error'").select((F.col("event_id") - F.get_json_object("props", "$.k").cast("long")).alias("event_id"), F.col("user_id") % 10 + F.lit(0).cast("long") + 0)
    gone = asked.toDF("event_id", "digit")
    own = e.withColumn("digit", F.col("user_id") % 10)
    return own.where("event_type <> 'error'").join(gone.distinct(), ["event_id", "digit"], "left_anti").groupBy("event_type").agg(F.count("*").alias("n"))


@query
def vanish_inclusive(spark, d):
    e = table(spark, d, "events")
    asked = e.where("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("until"))
    left = e.join(asked, "user_id", "left").where("until is null or ts > until or event_type = 'signup'")
    return left.groupBy("user_id").agg(F.count("*").alias("n"))


@query
def time_slices(spark, d):
    e = table(spark, d, "events")
    ends = e.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"))
    cut = F.least(F.lit(7).cast("long"), F.floor((F.col("event_id") - F.col("low")) * 8 / (F.col("high") - F.col("low") + 1)).cast("long"))
    return e.join(F.broadcast(ends)).groupBy(cut.alias("slice")).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query
def first_success_union(spark, d):
    o = table(spark, d, "orders")
    ranked = o.where("o_orderstatus is not null").select(F.col("o_custkey").alias("author"), F.col("o_orderpriority").alias("source"), "o_orderkey")
    return ranked.groupBy("author").agg(F.min(F.struct("source", "o_orderkey")).alias("s")).select("author", "s.source", "s.o_orderkey")


@query
def roster_union(spark, d):
    e = S.edges(spark, d)
    names = S.scores(spark, d).select(F.concat(F.lit("p"), F.col("subject")).alias("k")).union(e.select(F.concat(F.lit("o"), F.col("observer")))).union(e.select(F.concat(F.lit("s"), F.col("service"))))
    return names.distinct().groupBy(F.substring("k", 1, 1).alias("what")).agg(F.count("*").alias("n"))


@query
def observer_frontier(spark, d):
    scored = S.scores(spark, d).select("service", F.col("subject").cast("int").alias("subject"))
    return trust.frontier(S.edges(spark, d), scored, spark.range(1).select(F.lit(0).alias("observer")), S.shared_home(spark, "frontier"))


@query
def cursor_freshness(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("cursor"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
    return e.agg(F.min("cursor").alias("oldest"), F.max("cursor").alias("newest"), F.count_if(F.col("last") == "view").alias("capable"))


@query
def relay_work_map(spark, d):
    e = S.edges(spark, d)
    return e.groupBy("relay").agg(F.count_distinct("observer").alias("observers"), F.array_join(F.transform(F.sort_array(F.collect_set("service")), lambda x: x.cast("string")), ",").alias("services"))


@query
def oldest_newest(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


@query
def absent_everywhere(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "id")
    replicas = [o.where("o_orderstatus = 'F'"), o.where("o_orderpriority <> '5-LOW'")]
    return store.absent_everywhere(o, replicas).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query
def busiest_downloads(spark, d):
    by = S.scores(spark, d).groupBy("service").agg(F.count("*").alias("n"))
    top = by.orderBy(F.desc("n"), "service").limit(3).select(F.concat(F.lit("service "), "service").alias("label"), "n")
    others = F.greatest(F.count("*") - 3, F.lit(0).cast("long"))
    return top.union(by.agg(F.concat(F.lit("+"), others, F.lit(" more")), others))


@query
def trust_bands(spark, d):
    best = S.scores(spark, d).groupBy("service", "subject").agg(F.max("rank").alias("rank"))
    band = F.ntile(4).over(Window.partitionBy("service").orderBy(F.desc("rank"), "subject"))
    return best.withColumn("band", band.cast("long")).groupBy("service", "band").agg(F.count("*").alias("n"), F.min("rank").alias("least"), F.max("rank").alias("most"))


@query
def insert_if_missing(spark, d):
    held = table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("author"))
    seed = table(spark, d, "customer").select(F.col("c_custkey").alias("author"), F.col("c_name").alias("name"))
    return S.insert_missing(held, seed, ["author"])


@query
def services_covered(spark, d):
    want = S.edges(spark, d).groupBy("observer").agg(F.collect_set("service").alias("want"))
    have = S.edges(spark, d).where("service % 9 <> 0").groupBy("observer").agg(F.collect_set("service").alias("have"))
    none = F.array().cast("array<bigint>")
    return want.join(have, "observer", "left").select("observer", (F.size(F.array_except("want", F.coalesce("have", none))) == 0).alias("covered"))


@query
def download_labels(spark, d):
    at = lambda c: F.unix_date(F.to_date(c)).cast("long") * 86400
    by = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    k = F.col("user_id").cast("int")
    relay = F.concat(F.lit("wss://r"), F.col("user_id") % 5, F.lit(".example/"))
    since = F.when(F.col("user_id") % 3 != 0, at("a"))
    label = C.download_label(relay, F.array(k), F.array(F.concat(F.lit("author"), F.lpad(F.col("user_id").cast("string"), 6, "0"))), since, F.when(F.col("user_id") % 2 == 0, at("b")))
    return by.select("user_id", "event_type", label.alias("label"))


@query
def stream_dedup(spark, d):
    once = streams.deduplicated(streams.event_stream(spark, d))
    return streams.drained(once).groupBy("event_type").agg(F.count("*").alias("n"))


@query
def stream_tumbling_counts(spark, d):
    return streams.drained(streams.tumbling_counts(streams.event_stream(spark, d)), "complete")


#: Slices of time that a stream reads one by one, so that state lives through several batches.
SLICES = 5


def sliced(spark, d, late=None):
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    path, files = streams.in_slices(spark, rows, "ts", SLICES, late)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path), rows.schema


@query
def stream_ttl_dead(spark, d):
    """Users with three errors in a row, in a stream of several batches, and how long they count as dead; the marks that have lapsed are gone."""
    changes = streams.drained(streams.error_marks(sliced(spark, d)[0], 2, 2 * 86400.0))
    return streams.latest(changes).where("dead_until is not null").select("user_id", "errors", F.col("dead_until").cast("timestamp_ntz").alias("dead_until"))


@query
def stream_streaks(spark, d):
    """Each user's errors in a row at the end of a stream of several batches."""
    return streams.latest(streams.drained(streams.error_marks(sliced(spark, d)[0], 2, 10_000 * 86400.0))).select("user_id", "errors", (F.col("errors") >= 2).alias("dead"))


@query
def stream_late_windows(spark, d):
    """Events by day and type from a stream in which some come two batches late: counted in time, late, and after a backfill."""
    home = S.shared_home(spark, "windows")
    stream, schema = sliced(spark, d, F.col("event_id") % 7 == 0)
    held = streams.LateWindows(spark, home, "ts", 86_400_000, 3_600_000, ["event_type"])
    held_query = stream.writeStream.foreachBatch(held.put).trigger(availableNow=True).option("checkpointLocation", f"{home}-checkpoint").start()
    held_query.awaitTermination()
    in_time = S.saver(spark)(held.windows().select("start_ms", "event_type", F.col("n").alias("in_time")))
    held.backfill(schema)
    both = held.windows().join(in_time, ["start_ms", "event_type"], "left")
    return both.select((F.col("start_ms") / 1000).cast("long").alias("start"), "event_type", "n", (F.coalesce("in_time", F.lit(0).cast("long")) <= F.col("n")).alias("no_more_in_time"))
