"""Tags, urls, labels and other scalar expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_values(tags: Column, name: str) -> Column:
    """Values of all tags of a name that have one."""
    return F.transform(F.filter(tags, lambda t: (F.size(t) > 1) & (t[0] == name)), lambda t: t[1])


def first_tag(tags: Column, name: str) -> Column:
    """Value of the first tag of a name, null where there is none or it is empty."""
    values = tag_values(tags, name)
    return F.nullif(F.when(F.size(values) > 0, values[0]), F.lit(""))


def tag_index(tags: Column) -> Column:
    """``x:value`` for tags whose name is one letter."""
    return F.transform(F.filter(tags, lambda t: (F.size(t) > 1) & (F.length(t[0]) == 1)), lambda t: F.concat(t[0], F.lit(":"), t[1]))


def authority(url: Column) -> Column:
    """``scheme://host[:port]`` in lower case; the whole url where it can't be parsed."""
    joined = F.lower(F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY"))))
    return F.coalesce(joined, url)


def path(url: Column) -> Column:
    """The path without a slash at its end, with the query; empty where there is none."""
    query = F.try_parse_url(url, F.lit("QUERY"))
    return F.concat(F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/+$", ""), F.when(query.isNotNull(), F.concat(F.lit("?"), query)).otherwise(""))


def is_path_prefix(short: Column, long: Column) -> Column:
    return (short == "") | (short == long) | F.startswith(long, F.concat(short, F.lit("/")))


#: Fixed value: names that only a local network resolves, and address literals of loopback, private, link-local and shared ranges.
PRIVATE = r"^(localhost|.*\.local|.*\.onion|(10|127)(\.\d{1,3}){3}|(192\.168|169\.254|172\.(1[6-9]|2\d|3[01])|100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7]))(\.\d{1,3}){2}|\[?(::1|fe[89ab][0-9a-f]:.*|f[cd][0-9a-f]{2}:.*)\]?)$"


def routable(url: Column) -> Column:
    """Whether a url's host can be reached publicly; false where there is no host."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return host.isNotNull() & ~host.rlike(PRIVATE)


def spread_hash(text: str) -> Column:
    """A 31-polynomial over a text's characters, cut to 31 bits. ``text`` is a SQL expression."""
    return F.expr(f"aggregate(transform(filter(split({text}, ''), x -> x <> ''), x -> cast(ascii(x) as bigint)), 0L, (a, x) -> pmod(a * 31 + x, 4294967296)) & 2147483647")


def compact(n: Column) -> Column:
    """12M, 1.2M, 234k, 1.2k or the number itself."""
    return (
        F.when(n >= 10_000_000, F.concat(F.floor(n / 1_000_000).cast("string"), F.lit("M")))
        .when(n >= 1_000_000, F.format_string("%.1fM", n / 1_000_000))
        .when(n >= 100_000, F.concat(F.floor(n / 1000).cast("string"), F.lit("k")))
        .when(n >= 1000, F.format_string("%.1fk", n / 1000))
        .otherwise(n.cast("string"))
    )


def ago(now: Column, then: Column) -> Column:
    """How long ago, in the two largest units."""
    s = F.greatest(F.lit(0).cast("long"), now - then)
    part = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(unit))
    two = lambda big, b, small, c: F.concat(part(F.floor(s / big), b), F.lit(" "), part(F.floor(s % big / small), c), F.lit(" ago"))
    return F.when(s < 60, F.concat(part(s, "s"), F.lit(" ago"))).when(s < 3600, two(60, "m", 1, "s")).when(s < 86400, two(3600, "h", 60, "m")).otherwise(two(86400, "d", 3600, "h"))


def display_name(name: Column, display: Column) -> Column:
    chosen = F.coalesce(name, display)
    return F.when(F.trim(chosen) != "", chosen).otherwise("(no profile)")


def scope_key(kinds: Column, authors: Column) -> Column:
    """Kinds joined by commas (-1 for none), then the authors behind a colon."""
    joined = F.when(F.size(kinds) > 0, F.array_join(kinds.cast("array<string>"), ",")).otherwise("-1")
    return F.when(F.size(authors) > 0, F.concat(joined, F.lit(":"), F.array_join(authors.cast("array<string>"), ","))).otherwise(joined)


def looks_incomplete(reconciled: Column, capped: Column, need: Column, got: Column, first: Column) -> Column:
    return reconciled & ~capped & ((need > got) | ((got == 0) & first))


def config_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def config_int(text: Column, default: int, least: int) -> Column:
    return F.greatest(F.coalesce(text.try_cast("int"), F.lit(default)), F.lit(least))


def search_terms(query: Column) -> Column:
    """A query's words without ``key:value`` extensions."""
    return F.filter(F.split(F.trim(query), r"\s+"), lambda x: ~x.rlike(r"^\w+:\S+$") & (x != ""))


def normalised_url(url: Column) -> Column:
    """Scheme and host in lower case, ``/`` where there is no path, no fragment; null where there is no host."""
    host = F.lower(F.try_parse_url(url, F.lit("AUTHORITY")))
    query = F.try_parse_url(url, F.lit("QUERY"))
    rest = F.concat(F.coalesce(F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")), F.when(query.isNotNull(), F.concat(F.lit("?"), query)).otherwise(""))
    return F.concat(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))), F.lit("://"), host, rest)


def whole(n: Column, unit: str = "") -> Column:
    return F.concat(F.floor(n).cast("long").cast("string"), F.lit(unit))


def age(ms: Column) -> Column:
    """Milliseconds as 45s, 3m or 1h15m."""
    s = F.floor(ms / 1000)
    return F.when(s >= 3600, F.concat(whole(s / 3600, "h"), whole(s % 3600 / 60, "m"))).when(s >= 60, whole(s / 60, "m")).otherwise(whole(s, "s"))


def coarse_duration(s: Column) -> Column:
    """Seconds as 5m, 2h 5m or 3d 4h."""
    hours = F.concat(whole(s / 3600, "h "), whole(s % 3600 / 60, "m"))
    return F.when(s < 3600, whole(s / 60, "m")).when(s < 86400, hours).otherwise(F.concat(whole(s / 86400, "d "), whole(s % 86400 / 3600, "h")))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def percent(part: Column, of: Column) -> Column:
    """A share in whole per cent, the product of the share and 100 cut off (so 29 of 100 are 28); 0 of nothing."""
    return F.when(of > 0, (part.cast("double") / of * 100).cast("int")).otherwise(0)


def day_label(at: Column) -> Column:
    """Month and day of epoch seconds, an ellipsis for an open end."""
    return F.coalesce(F.date_format(F.date_from_unix_date(F.floor(at / 86400).cast("int")), "MM-dd"), F.lit("\u2026"))


def download_label(relay: Column, kinds: Column, authors: Column, since: Column, until: Column) -> Column:
    """The relay, the first kind, eight characters of the first author, and the window where there is one."""
    window = F.when(since.isNotNull() | until.isNotNull(), F.concat(F.lit(" "), day_label(since), F.lit(".."), day_label(until))).otherwise("")
    kind = F.coalesce(F.concat(F.lit(" k"), F.get(kinds, F.lit(0)).cast("string")), F.lit(""))
    author = F.coalesce(F.concat(F.lit(" "), F.substring(F.get(authors, F.lit(0)), 1, 8)), F.lit(""))
    return F.concat(F.regexp_replace(relay, "^wss?://|/$", ""), kind, author, window)


def since_with_slack(cursor: Column, since: Column, slack: int = 3600) -> Column:
    """Where a scope goes on: its cursor less the slack, or where its filter begins."""
    return F.coalesce(cursor - slack, since)


def search_extension(query: Column, name: str) -> Column:
    """The value of ``name:value`` in a query, null without one."""
    return F.nullif(F.regexp_extract(query, rf"(?:^|\s){name}:(\S+)", 1), F.lit(""))


def least_rank(query: Column) -> Column:
    return search_extension(query, "filter:rank").try_cast("int")


def includes_spam(query: Column) -> Column:
    return F.coalesce(search_extension(query, "include") == "spam", F.lit(False))


def geohash_near(tags: Column, cells: list[str]) -> Column:
    """Whether an event stands in one of the geohash cells; an event names its cell and those around it."""
    return F.arrays_overlap(tag_values(tags, "g"), F.array(*map(F.lit, cells))) if cells else F.lit(False)


def location_text(tags: Column) -> Column:
    return F.array_join(tag_values(tags, "location"), " ")


def profile_field(content: Column, name: str) -> Column:
    """A field of a profile's JSON, null where it is missing or blank."""
    value = F.get_json_object(content, f"$.{name}")
    return F.when(F.trim(value) != "", value)


def log_class(line: Column) -> Column:
    """What a line of the log is: phase, gauge, failure, warning, done, progress, tag or note."""
    body = F.ltrim(line)
    hard = body.rlike("(?i)fail|timed out|MISSING|invalid|dropped|unreliable")
    trouble = F.when(hard, "failure").otherwise("warning")
    heads = [("===", F.lit("phase")), ("~", F.lit("gauge")), ("!", trouble), ("DONE", F.lit("done"))]
    out = F.when(body.rlike(r"^\[[^\]]*\d+/\d+\]"), "progress").when(body.rlike(r"(?i)^\[[a-z0-9 ]+\]"), "tag").otherwise("note")
    for head, name in reversed(heads):
        out = F.when(F.startswith(body, F.lit(head)), name).otherwise(out)
    return out


def busy_gauge(verify: Column, wait: Column, insert: Column) -> Column:
    """The share of time in verifying, waiting and inserting; empty while nothing goes on."""
    share = F.least(F.lit(100), F.floor(insert * 100)).cast("int")
    return F.when(verify + wait + insert < 0.005, "").otherwise(F.format_string("vrf %.1fx wait %.1fx ins %d%%", verify, wait, share))


def status_line(phase: Column, done: Column, total: Column, received: Column, rate: Column, inserted: Column, busy: Column) -> Column:
    """Position, totals with their rate, and the gauge, between bars."""
    per = F.when(rate > 0, F.concat(F.lit(" ("), compact(rate), F.lit("/s)"))).otherwise("")
    parts = [F.concat(F.lit("  ~ "), phase, F.lit(" "), whole(done, "/"), whole(total)), F.concat(F.lit("recv "), compact(received), per, F.lit(" new "), compact(inserted)), F.nullif(busy, F.lit(""))]
    return F.concat_ws(" | ", *parts)
