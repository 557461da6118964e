"""Current state of an append-only log: duplicates, deletions, erasure, supersession, expiry; and set differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlake.functions.columns import first_tag, tag_values
from trustlake.operators.filters import unexpired
from trustlake.schema import DELETION, VANISH
from trustlake.sources.tables import spread


#: Kinds of events that are passed on and not stored.
EPHEMERAL = (20000, 29999)


def newest(rows: DataFrame, keys: list[str], at: str = "created_at", ids: list[str] | None = None) -> DataFrame:
    """The newest row of each key, ties to the lowest id."""
    order = Window.partitionBy(*keys).orderBy(F.desc(at), *(ids or ["id"]))
    return rows.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def deleted_ids(events: DataFrame) -> DataFrame:
    """id, pubkey that explicit deletions name; they bind only their own author."""
    return events.where(F.col("kind") == DELETION).select(F.explode(tag_values(F.col("tags"), "e")).alias("id"), "pubkey").distinct()


def deleted_addresses(events: DataFrame) -> DataFrame:
    """kind, pubkey, d and the time up to which a deletion by address holds."""
    parts = events.where(F.col("kind") == DELETION).select("pubkey", "created_at", F.explode(F.transform(tag_values(F.col("tags"), "a"), lambda a: F.split(a, ":", 3))).alias("a"))
    named = parts.where(F.size("a") == 3).select(F.col("a")[0].try_cast("int").alias("kind"), F.col("a")[1].alias("owner"), F.col("a")[2].alias("d"), "pubkey", "created_at").where("owner = pubkey")
    return named.groupBy("kind", "pubkey", "d").agg(F.max("created_at").alias("until"))


def erasures(events: DataFrame) -> DataFrame:
    """pubkey and the time up to which an author's events are erased."""
    return events.where(F.col("kind") == VANISH).groupBy("pubkey").agg(F.max("created_at").alias("erased_until"))


def slotted(events: DataFrame) -> DataFrame:
    """``events`` with expires_at and slot: of the events of an author, a kind and a slot the newest one counts.

    Replaceable kinds have one slot, addressable ones one for each ``d``, all others one for each event.
    """
    kind = F.col("kind")
    replaceable = kind.isin(0, 3) | kind.between(10000, 19999)
    slot = F.when(replaceable, F.lit("")).when(kind.between(30000, 39999), F.coalesce(first_tag(F.col("tags"), "d"), F.lit(""))).otherwise(F.col("id"))
    return events.withColumn("expires_at", first_tag(F.col("tags"), "expiration").try_cast("long")).withColumn("slot", slot)


def stored_events(events: DataFrame, ephemeral: tuple[int, int] = EPHEMERAL) -> DataFrame:
    """What a store holds of a log, with ``expires_at``; expired events count until they are swept. Deletions and erasures read the raw log, so they outlive supersession.

    Erasure takes all of an author's events up to its time, itself excepted; explicit deletions leave deletions and
    erasures alone. Replaceable kinds keep one event per author, addressable ones one per author and ``d``. An id stands
    for one author's event, as it is the hash of both.

    A deletion by id joins the rows of its target while copies are put together, and one by address those of its slot
    while the newest is chosen; both are aggregates that are partly done before the rows are dealt out.
    """
    names, plumbing = events.columns, F.col("kind").isin(DELETION, VANISH)
    event = F.struct(*names)
    asked = events.where(F.col("kind") == DELETION)
    whole = events.select(event.alias("event"))
    none = F.lit(None).cast(whole.schema["event"].dataType)
    # an event stands for itself, and a deletion for each id that it names too
    own = F.array(F.struct(F.col("id").alias("id"), event.alias("event"), F.lit(False).alias("named")))
    ids = F.when(F.col("kind") == DELETION, F.transform(tag_values(F.col("tags"), "e"), lambda i: F.struct(i.alias("id"), none.alias("event"), F.lit(True).alias("named"))))
    rows = events.where(~F.col("kind").between(*ephemeral)).select("pubkey", F.explode(F.when(F.col("kind") == DELETION, F.concat(own, ids)).otherwise(own)).alias("s")).select("s.id", "pubkey", "s.event", "s.named")
    once = rows.groupBy("id", "pubkey").agg(F.first("event", ignorenulls=True).alias("event"), F.bool_or("named").alias("named")).where("event is not null").select("event.*", "named")
    once = once.where(plumbing | ~F.col("named")).drop("named").join(erasures(events), "pubkey", "left")
    once = slotted(once.where(F.col("erased_until").isNull() | (F.col("created_at") > F.col("erased_until")) | (F.col("kind") == VANISH)).select(*names))
    keys, kept = ["pubkey", "kind", "slot"], F.struct(*names, "expires_at")
    addressed = asked.select("pubkey", "created_at", F.explode(F.transform(tag_values(F.col("tags"), "a"), lambda a: F.split(a, ":", 3))).alias("a"))
    bars = addressed.where((F.size("a") == 3) & (F.col("a")[1] == F.col("pubkey"))).select("pubkey", F.col("a")[0].try_cast("int").alias("kind"), F.col("a")[2].alias("slot"), F.col("created_at").alias("until")).where(~plumbing)
    slots = once.select(*keys, kept.alias("event"), F.lit(None).cast("long").alias("until"))
    slots = slots.unionByName(bars.select(*keys, F.lit(None).cast(slots.schema["event"].dataType).alias("event"), "until"))
    order = F.struct(-F.col("event.created_at"), F.col("event.id"))
    newest_of = slots.groupBy(*keys).agg(F.min_by("event", F.when(F.col("event").isNotNull(), order)).alias("event"), F.max("until").alias("until"))
    return newest_of.where("event is not null and (until is null or event.created_at > until)").select("event.*")


def current_events(events: DataFrame, now: int) -> DataFrame:
    """What queries see of a log at ``now``."""
    return unexpired(stored_events(events), now)


def id_snapshot(events: DataFrame) -> DataFrame:
    """id, created_at of all that is stored, expired or not, for reconciling with other stores."""
    return stored_events(events).select("id", "created_at")


def swept(stored: DataFrame, now: int) -> DataFrame:
    """The store after a sweep of what has expired."""
    return unexpired(stored, now)


def need_have(local: DataFrame, remote: DataFrame, key: str = "id") -> DataFrame:
    """key and side: ``need`` stands only remotely, ``have`` only locally; a null key is never found on the other side.

    Both sides are dealt out by key once and met in one aggregate, in partitions that are not put together again.
    """
    none = F.lit(False)
    both = local.select(key, F.lit(True).alias("local"), none.alias("remote")).union(remote.select(key, none, F.lit(True)))
    held = spread(both, key).groupBy(key).agg(F.bool_or("local").alias("local"), F.bool_or("remote").alias("remote"))
    only = lambda side, other, name: F.when(F.col(side) & (~F.col(other) | F.isnull(key)), F.lit(name))
    sides = F.array_compact(F.array(only("remote", "local", "need"), only("local", "remote", "have")))
    return held.select(key, F.explode(sides).alias("side"))


class MassDeletion(ValueError):
    """More of a scope would be deleted than a pass is trusted with."""


def guarded(marked: DataFrame, save, flag: str = "gone", most: float = 0.5, scope: list[str] | None = None, spared: int = 0) -> DataFrame:
    """The rows with ``flag``, unless they are more than ``most`` of all rows, which looks like a failed listing.

    With ``scope`` shares are taken for each of its values, and a scope beyond ``most`` loses nothing, while the others
    do; up to ``spared`` rows may go from any scope, whatever their share. Without, a share beyond ``most`` raises
    ``MassDeletion``. ``save`` writes the marked rows once; the guard and the result read them.
    """
    marked = save(marked)
    count = [F.count("*").alias("n"), F.count_if(flag).alias("gone")]
    refused = (F.col("gone") > most * F.col("n")) & (F.col("gone") > spared)
    if scope is None:
        if marked.agg(*count).where(refused).first():
            raise MassDeletion(f"more than {most:.0%} of the held rows would be deleted")
        return marked.where(flag).drop(flag)
    bad = marked.groupBy(*scope).agg(*count).where(refused)
    # null-safe, so a scope without a name is guarded too
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"b.{c}")) for c in scope]
    kept = marked.where(flag).drop(flag).alias("m")
    return kept.join(bad.alias("b"), same, "left_anti")


def refused_scopes(marked: DataFrame, scope: list[str], flag: str = "gone", most: float = 0.5, spared: int = 0) -> DataFrame:
    """The scopes that ``guarded`` leaves alone, with how many rows they hold and how many would have gone."""
    by = marked.groupBy(*scope).agg(F.count("*").alias("n"), F.count_if(flag).alias("gone"))
    return by.where((F.col("gone") > most * F.col("n")) & (F.col("gone") > spared))


def stale(held: DataFrame, served: DataFrame, complete: bool, save, key: str = "id", most: float = 0.5) -> DataFrame:
    """Held rows that a replica no longer serves. An incomplete or capped listing proves nothing: then none."""
    if not complete:
        return held.limit(0)
    listed = served.select(key).distinct().withColumn("served", F.lit(True))
    return guarded(held.join(listed, key, "left").withColumn("gone", F.col("served").isNull()).drop("served"), save, most=most)


def proven_scope(held: DataFrame, served: DataFrame, homes: DataFrame, listings: DataFrame) -> DataFrame:
    """The held scores about which listings prove something, with relay and ``gone``: whether the relay no longer serves them."""
    proven = homes.join(listings.where("complete and not capped").select("relay").distinct(), "relay")
    given = served.select("id", "relay").distinct().withColumn("served", F.lit(True))
    return held.join(proven, "service").join(given, ["id", "relay"], "left").withColumn("gone", F.col("served").isNull()).drop("served")


def absence_deletions(held: DataFrame, served: DataFrame, homes: DataFrame, listings: DataFrame, save, most: float = 0.5, spared: int = 0) -> DataFrame:
    """Held scores (id, service) that their service's one relay no longer serves.

    ``homes`` has service and relay of services hinted on a single relay, ``listings`` relay, complete, capped of what
    the relays were asked for, ``served`` the ids and relays of what they gave. Only complete listings without a cap of
    a service's only relay prove anything. A service that would lose more than ``most`` of its scores at a relay, and
    more than ``spared`` of them, loses none; other services are judged on their own.
    """
    return guarded(proven_scope(held, served, homes, listings), save, most=most, scope=["service", "relay"], spared=spared)


def absent_everywhere(held: DataFrame, replicas: list[DataFrame], key: str = "id") -> DataFrame:
    """Held rows that no replica serves."""
    for served in replicas:
        held = held.join(served.select(key), key, "left_anti")
    return held


def ledger_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """A keyed upsert in which a missing new field leaves the old one; what comes later overwrites, even with less."""
    both = old.alias("o").join(new.alias("n"), "pubkey", "full_outer")
    fields = ("content_synced_at", "outbox_checked_at")
    return both.select("pubkey", *[F.coalesce(F.col(f"n.{f}"), F.col(f"o.{f}"), F.lit(0).cast("long")).alias(f) for f in fields])


def refresh_slice(ledger: DataFrame, cutoff: int, limit: int) -> DataFrame:
    """The stalest authors that were synced once and not since ``cutoff``."""
    due = ledger.where(F.col("content_synced_at").between(1, cutoff))
    return due.orderBy("content_synced_at", "pubkey").limit(max(limit, 0))
