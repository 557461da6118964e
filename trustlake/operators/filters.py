"""The filter value: kinds, authors, ids, tags, times, exclusions and expiry, as one predicate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventFilter:
    """Fields are joined by AND, values of a field by OR. None means no condition; an empty list matches nothing."""

    ids: tuple | None = None
    authors: tuple | None = None
    kinds: tuple | None = None
    not_kinds: tuple = ()
    tags: dict = field(default_factory=dict)
    since: object = None
    until: object = None
    expires_before: object = None
    limit: int = 0

    def predicate(self, columns: dict[str, str] | None = None) -> Column:
        name = {c: c for c in ("id", "pubkey", "kind", "created_at", "tag_index", "expires_at")} | (columns or {})
        out = F.lit(True)
        for values, c in ((self.ids, "id"), (self.authors, "pubkey"), (self.kinds, "kind")):
            if values is not None:
                out = out & (F.col(name[c]).isin(*values) if values else F.lit(False))
        if self.not_kinds:
            out = out & ~F.col(name["kind"]).isin(*self.not_kinds)
        for letter, values in self.tags.items():
            out = out & (F.arrays_overlap(F.col(name["tag_index"]), F.array(*[F.lit(f"{letter}:{v}") for v in values])) if values else F.lit(False))
        if self.since is not None:
            out = out & (F.col(name["created_at"]) >= self.since)
        if self.until is not None:
            out = out & (F.col(name["created_at"]) <= self.until)
        if self.expires_before is not None:
            out = out & (F.col(name["expires_at"]) < self.expires_before)
        return out

    def scan(self, events: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
        """The rows of a filter; with a limit the newest, ties by id."""
        found = events.where(self.predicate(columns))
        name = {"created_at": "created_at", "id": "id"} | (columns or {})
        return found.orderBy(F.desc(name["created_at"]), name["id"]).limit(self.limit) if self.limit > 0 else found


def by_many_keys(events: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """A filter on more keys than a list should hold: a semi join, for Spark to choose how."""
    return events.join(keys.select(column).distinct(), column, "left_semi")


def visible(expires_at: Column, now) -> Column:
    """What queries and counts see: an event is hidden from the moment it expires."""
    return expires_at.isNull() | (expires_at > now)


def unexpired(events: DataFrame, now: int) -> DataFrame:
    """The view that queries and counts read; id snapshots read the table itself."""
    return events.where(visible(F.col("expires_at"), now))
