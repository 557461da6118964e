"""DuckDB SQL of the queries over the event log and a crawl's state."""

from trustlake.plans.oracle import EDGES, LEDGER

NOW = 1_706_659_200
LOG = """base AS (
  SELECT event_id, lpad(CAST(event_id AS VARCHAR), 10, '0') AS id, 'u' || (user_id % 20) AS pubkey, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS created_at, CAST(props->>'$.k' AS INT) AS k, event_id % 16 AS m FROM events),
log AS (
  SELECT *, CASE m WHEN 0 THEN 0 WHEN 3 THEN 3 WHEN 4 THEN 5 WHEN 5 THEN 5 WHEN 6 THEN CASE WHEN event_id % 160 = 6 THEN 62 ELSE 1 END WHEN 7 THEN 10002 WHEN 8 THEN 10040 WHEN 9 THEN 10086 WHEN 10 THEN 20001 WHEN 11 THEN 30000 WHEN 12 THEN 30382 WHEN 13 THEN 30382 WHEN 15 THEN 30382 ELSE 1 END AS kind,
         CASE WHEN m = 11 THEN CAST(k % 5 AS VARCHAR) WHEN m IN (12, 13, 15) AND k % 13 <> 0 THEN 'u' || (k % 20) ELSE '' END AS d,
         CASE WHEN m = 14 THEN CASE WHEN k % 8 = 0 THEN 1706659200 ELSE created_at + (k - 50) * 43200 END WHEN event_id % 96 = 0 OR event_id % 80 = 4 THEN 1 END AS expires_at FROM base)"""


def stored(log: str, held: str) -> str:
    """SQL of what a store holds of ``log``, as a table expression named ``held``."""
    return f"""{held}_erased AS (SELECT pubkey, max(created_at) AS until FROM {log} WHERE kind = 62 GROUP BY 1),
{held}_by_id AS (SELECT DISTINCT lpad(CAST(event_id - k % 40 AS VARCHAR), 10, '0') AS id, pubkey FROM {log} WHERE m = 4),
{held}_by_address AS (SELECT pubkey, CAST(k % 5 AS VARCHAR) AS d, max(created_at) AS until FROM {log} WHERE m = 5 AND k % 3 <> 0 GROUP BY 1, 2),
{held}_rest AS (
  SELECT l.* FROM {log} l LEFT JOIN {held}_erased e USING (pubkey) LEFT JOIN {held}_by_id i ON i.id = l.id AND i.pubkey = l.pubkey LEFT JOIN {held}_by_address a ON a.pubkey = l.pubkey AND a.d = l.d AND l.kind = 30000
  WHERE l.kind <> 20001 AND (e.until IS NULL OR l.created_at > e.until OR l.kind = 62) AND (l.kind IN (5, 62) OR (i.id IS NULL AND (a.until IS NULL OR l.created_at > a.until)))),
{held} AS (
  SELECT * FROM {held}_rest QUALIFY row_number() OVER (PARTITION BY pubkey, kind, CASE WHEN kind IN (0, 3) OR kind BETWEEN 10000 AND 19999 THEN '' WHEN kind BETWEEN 30000 AND 39999 THEN d ELSE id END ORDER BY created_at DESC, id) = 1)"""


STORED = f"{LOG},\n{stored('log', 'held')}"
#: What had not expired when it came.
ARRIVED = f"{LOG}, arrived AS (SELECT * FROM log WHERE expires_at IS NULL OR expires_at > {NOW})"
CUR = f"{STORED}, cur AS (SELECT * FROM held WHERE expires_at IS NULL OR expires_at > {NOW})"
LISTS = f"""{CUR}, lists AS (SELECT * FROM cur WHERE kind = 10040),
edges AS (SELECT pubkey AS observer, 'u' || (k % 20) AS service, 'wss://r' || (k % 3) || '.example' AS relay FROM lists UNION ALL SELECT pubkey, 'u' || ((k + 3) % 20), NULL FROM lists),
scores AS (SELECT pubkey AS service, d AS subject, CASE WHEN k % 10 <> 0 THEN k END AS rank, created_at, id, event_id FROM cur WHERE kind = 30382 AND d <> '')"""
REPUTATION = "SELECT observer, subject, max(rank) AS rank FROM (SELECT DISTINCT observer, service FROM edges) JOIN scores USING (service) WHERE rank IS NOT NULL GROUP BY 1, 2"
TIERS = f"""{LISTS}, tiers AS (
  SELECT id, pubkey AS author, CASE WHEN kind = 0 THEN 'name w' || (k % 7) || CASE WHEN k % 2 = 0 THEN ' shown ' || (k % 3) ELSE '' END WHEN m = 2 THEN 'subject w' || (k % 4) WHEN kind = 30000 THEN 'list w' || (k % 9) ELSE '' END AS "primary",
         CASE WHEN kind = 0 THEN 'about w' || (k % 11) WHEN m = 2 THEN 'tag' || (k % 6) WHEN kind = 30000 THEN 'about w' || (k % 2) ELSE '' END AS secondary,
         CASE WHEN m IN (1, 2, 6, 14) THEN 'note w' || (k % 11) || ' on w' || (k % 5) ELSE '' END AS body, CASE WHEN m = 2 THEN 'place ' || (k % 3) ELSE '' END AS location FROM cur)"""


def bm25(weights: dict[str, float], match: str, terms: list[str], trusted: str, floor: str) -> str:
    """SQL of a search over ``tiers``; ``match`` tells whether the word w is the term t."""
    long = " UNION ALL ".join(f"SELECT id, author, {w}::DOUBLE AS weight, '{c}' AS tier, list_filter(string_split(\"{c}\", ' '), lambda x: x <> '') AS words FROM tiers" for c, w in weights.items())
    values = ", ".join(f"('{t}')" for t in terms)
    return f"""{TIERS}, long AS ({long}), asked(t) AS (VALUES {values}),
counts AS (SELECT id, author, weight, tier, t, len(words) AS n, (SELECT count(*) FROM (SELECT unnest(words) AS w) WHERE {match}) AS tf FROM long, asked),
stats AS (SELECT tier, t, count(*) AS docs, avg(n) AS mean, count(*) FILTER (tf > 0) AS df FROM counts GROUP BY 1, 2),
ranked AS (SELECT id, author, sum(weight * ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))) AS score FROM counts JOIN stats USING (tier, t) WHERE tf > 0 GROUP BY 1, 2),
trusted AS ({trusted})
SELECT id, author, round(score * (1 + coalesce(trust, 0.0)), 6) AS score FROM ranked LEFT JOIN trusted USING (author) WHERE coalesce(trust, 0.0) >= {floor}"""


ALL_TIERS = {"primary": 3.0, "secondary": 2.0, "body": 1.0, "location": 0.5}
RUNS = "runs AS (SELECT o_custkey % 50 AS relay, o_orderpriority AS scope, o_orderkey AS ended_at, o_orderstatus <> 'P' AS completed FROM orders)"
SCOPE = "['1-URGENT', '2-HIGH', '5-LOW']"
CURSORS = f"cursors AS (SELECT c_custkey % 60 AS relay, {SCOPE}[c_custkey // 60 % 3 + 1] AS scope, max(c_custkey) AS last_synced_at FROM customer GROUP BY 1, 2)"
RELAYS = "l AS (SELECT DISTINCT o_custkey AS author, 'r' || (o_orderkey % 7) AS relay FROM orders)"
#: A number in short form, rounded half up to a tenth.
COMPACT = "CASE WHEN {0} >= 10000000 THEN ({0} // 1000000) || 'M' WHEN {0} >= 1000000 THEN (({0} * 10 + 500000) // 1000000 // 10) || '.' || (({0} * 10 + 500000) // 1000000 % 10) || 'M' WHEN {0} >= 100000 THEN ({0} // 1000) || 'k' WHEN {0} >= 1000 THEN (({0} * 10 + 500) // 1000 // 10) || '.' || (({0} * 10 + 500) // 1000 % 10) || 'k' ELSE CAST({0} AS VARCHAR) END"
#: The customers' places.
PLACES = """places AS (
  SELECT c_custkey, CASE c_custkey % 50 WHEN 0 THEN 90.0 WHEN 1 THEN -90.0 ELSE (c_custkey * 7919 % 180001 - 90000) / 1000.0 END::DOUBLE AS lat,
         CASE c_custkey % 40 WHEN 0 THEN 180.0 WHEN 1 THEN -180.0 ELSE (c_custkey * 104729 % 360001 - 180000) / 1000.0 END::DOUBLE AS lon FROM customer)"""


def bisected(points: str, bits: int, name: str = "cells") -> str:
    """SQL of the cells of points (id, lat, lon): the ranges are halved once for each bit, by turns; points may repeat an id."""
    return f"""{name}_cut AS (
  SELECT id, lat, lon, -180.0::DOUBLE AS a, 180.0::DOUBLE AS b, -90.0::DOUBLE AS c, 90.0::DOUBLE AS d, 0 AS step, '' AS word, 0 AS v FROM {points}
  UNION ALL
  SELECT id, lat, lon, CASE WHEN even AND up THEN (a + b) / 2 ELSE a END, CASE WHEN even AND NOT up THEN (a + b) / 2 ELSE b END,
         CASE WHEN NOT even AND up THEN (c + d) / 2 ELSE c END, CASE WHEN NOT even AND NOT up THEN (c + d) / 2 ELSE d END,
         step + 1, CASE WHEN step % 5 = 4 THEN word || '0123456789bcdefghjkmnpqrstuvwxyz'[v * 2 + up::INT + 1] ELSE word END, CASE WHEN step % 5 = 4 THEN 0 ELSE v * 2 + up::INT END
  FROM (SELECT *, step % 2 = 0 AS even, CASE WHEN step % 2 = 0 THEN lon >= (a + b) / 2 ELSE lat >= (c + d) / 2 END AS up FROM {name}_cut WHERE step < {bits})),
{name} AS (SELECT id, word AS code, a, b, c, d FROM {name}_cut WHERE step = {bits})"""


def around(precision: int) -> str:
    """SQL of the cells round the places: the middles of the neighbours, over the date line and the poles, are looked up."""
    return f"""points{precision} AS (SELECT c_custkey AS id, lat, lon FROM places), {bisected(f'points{precision}', 5 * precision, f'own{precision}')},
moved{precision} AS (SELECT id, (c + d) / 2 + y * (d - c) AS lat, (a + b) / 2 + x * (b - a) AS lon FROM own{precision}, (VALUES (-1), (0), (1)) h(x), (VALUES (-1), (0), (1)) v(y)),
turned{precision} AS (SELECT id, CASE WHEN lat > 90 THEN 180 - lat WHEN lat < -90 THEN -180 - lat ELSE lat END AS lat, CASE WHEN abs(lat) > 90 THEN lon + 180 ELSE lon END AS lon FROM moved{precision}),
there{precision} AS (SELECT id, lat, lon - 360 * floor((lon + 180) / 360) AS lon FROM turned{precision}), {bisected(f'there{precision}', 5 * precision, f'all{precision}')},
near{precision} AS (SELECT id AS c_custkey, array_to_string(list_sort(list_distinct(list(code))), ' ') AS near{precision} FROM all{precision} GROUP BY 1)"""


ORACLE = {
    "log_current_events": f"WITH {CUR} SELECT id, pubkey, kind, created_at FROM cur",
    "log_visible_of_stored": f"WITH {STORED} SELECT kind, count(*) AS stored, count(*) FILTER (expires_at IS NULL OR expires_at > {NOW}) AS visible FROM held GROUP BY 1",
    "log_provider_edges": f"WITH {LISTS} SELECT * FROM edges",
    "log_scores": f"WITH {LISTS} SELECT service, subject, rank, created_at FROM scores",
    "log_reputation": f"WITH {LISTS} {REPUTATION}",
    "log_outboxes": f"""WITH {LISTS}, o AS (SELECT 'u0' AS observer UNION SELECT 'u99' UNION SELECT pubkey FROM lists),
own AS (SELECT pubkey AS observer, 'wss://r' || (k % 7) || '.example' AS relay FROM cur WHERE kind = 10002 AND k % 4 <> 0 UNION SELECT pubkey, 'wss://w' || (k % 3) || '.example' FROM cur WHERE kind = 10002 AND k % 2 <> 0)
SELECT observer, relay, true AS own FROM o JOIN own USING (observer) UNION ALL SELECT observer, relay, false FROM o, (VALUES ('wss://i9.example'), ('wss://i5.example')) s(relay) WHERE observer NOT IN (SELECT observer FROM own)""",
    "log_index_relays": f"""WITH {CUR}, a AS (SELECT 'u' || i AS author FROM range(20) r(i) UNION ALL SELECT 'u77'), n AS (SELECT author, k FROM a LEFT JOIN cur ON pubkey = author AND kind = 10086)
SELECT author, 0 AS pos, CASE WHEN k % 3 <> 0 THEN 'wss://i' || (k % 4) || '.example' ELSE 'wss://i9.example' END AS relay FROM n UNION ALL SELECT author, 1, CASE WHEN k % 3 <> 0 THEN 'wss://i9.example' ELSE 'wss://i5.example' END FROM n""",
    "log_index_and_seeds": f"""WITH {CUR}, n AS (SELECT max(k) AS k FROM cur WHERE pubkey = 'u1' AND kind = 10086),
r AS (SELECT 'wss://i' || (k % 4) || '.example' AS relay, 0 AS list, 0 AS pos FROM n WHERE k % 3 <> 0 UNION ALL SELECT 'wss://i9.example', 0, CASE WHEN k % 3 <> 0 THEN 1 ELSE 0 END FROM n UNION ALL SELECT 'wss://i5.example', 0, 1 FROM n WHERE k IS NULL OR k % 3 = 0 UNION ALL VALUES ('wss://i9.example', 1, 0), ('wss://i5.example', 1, 1))
SELECT relay, CAST(list AS INT) AS list, CAST(pos AS BIGINT) AS pos FROM r QUALIFY row_number() OVER (PARTITION BY relay ORDER BY list, pos) = 1""",
    "log_provider_relays": f"""WITH {LISTS}, h AS (SELECT 'u' || (k % 20) AS service, 'wss://r' || (k % 3) || '.example' AS relay, created_at FROM lists)
SELECT service, relay, (SELECT count(DISTINCT relay) FROM h g WHERE g.service = h.service) AS hints FROM h QUALIFY row_number() OVER (PARTITION BY service ORDER BY created_at DESC, relay) = 1""",
    "log_observers": f"WITH {LISTS} SELECT observer, observer = 'u0' AS house FROM (SELECT 'u0' AS observer UNION SELECT 'u99' UNION SELECT 'u3' UNION SELECT pubkey FROM lists)",
    "log_absence_deletions": f"""WITH {LISTS}, homes AS (SELECT service, min(relay) AS relay FROM edges GROUP BY 1 HAVING count(DISTINCT relay) = 1),
scope AS (SELECT id, service, relay, event_id % 7 = 0 OR event_id // 100 % 2 = 0 AND service IN ('u3', 'u5', 'u8') AS gone FROM scores JOIN homes USING (service) WHERE relay <> 'wss://r2.example'),
refused AS (SELECT service FROM scope GROUP BY 1 HAVING count(*) FILTER (gone) > 0.5 * count(*))
SELECT id, service, relay FROM scope WHERE gone AND service NOT IN (SELECT service FROM refused)""",
    "log_text_tiers": f"WITH {TIERS} SELECT * FROM tiers WHERE \"primary\" <> '' OR secondary <> '' OR body <> '' OR location <> ''",
    "log_search_tiers": "WITH " + bm25({"primary": 3.0, "secondary": 2.0, "body": 1.0, "location": 0.5}, "w = t", ["w3", "place"], f"SELECT subject AS author, sum(CASE observer WHEN 'u1' THEN 1.0 ELSE 0.5 END * rank) / 100.0 AS trust FROM ({REPUTATION}) WHERE observer IN ('u1', 'u2') GROUP BY 1", "0.2"),
    "log_search_unknown_observer": "WITH " + bm25(ALL_TIERS, "w = t", ["w3", "place"], "SELECT 'x' AS author, 0.0 AS trust", "0.0").replace("SELECT id, author, round", ", hits AS (SELECT id, author, round", 1) + f") SELECT who, CASE WHEN EXISTS (SELECT 1 FROM ({REPUTATION}) WHERE observer = who) THEN (SELECT count(*) FROM hits) ELSE 0 END AS n FROM (VALUES ('u1'), ('u2'), ('nobody')) v(who)",
    "log_search_newest": "WITH " + bm25(ALL_TIERS, "w = t", ["w3", "place"], f"SELECT subject AS author, rank / 100.0 AS trust FROM ({REPUTATION}) WHERE observer = 'u1'", "-1").replace("SELECT id, author, round", ", hits AS (SELECT id, round", 1) + ") SELECT id, created_at, score FROM hits JOIN cur USING (id) ORDER BY created_at DESC, id LIMIT 20",
    "log_search_top": "WITH " + bm25(ALL_TIERS, "w = t", ["w3", "place"], f"SELECT subject AS author, sum(CASE observer WHEN 'u1' THEN 1.0 ELSE 0.5 END * rank) / 100.0 AS trust FROM ({REPUTATION}) WHERE observer IN ('u1', 'u2') GROUP BY 1", "0.0") + " ORDER BY score DESC, id LIMIT 15",
    "log_standing": f"""WITH {LISTS}, e AS (SELECT DISTINCT observer, service FROM edges),
now AS (SELECT * FROM e WHERE observer <> 'u1' AND (observer[-1:] IN ('0', '2', '4', '6', '8') OR service[-1:] <> '3'))
SELECT observer, subject, max(rank) AS rank FROM now JOIN scores USING (service) WHERE rank IS NOT NULL AND subject <> 'u7' GROUP BY 1, 2""",
    "log_search_fuzzy": "WITH " + bm25({"body": 1.0, "location": 1.0}, "levenshtein(w, t) <= 1", ["plase", "noted"], "SELECT 'u1' AS author, 0.5 AS trust", "0.0"),
    "search_extensions": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS least, split_part(lower(p_type), ' ', 1) AS sort, p_size % 3 = 0 AS spam FROM part",
    "content_kinds": f"WITH {LOG} SELECT kind, count(*) AS n FROM log WHERE kind IN (0, 1, 5, 62, 30000) GROUP BY 1",
    "log_crawl": f"""WITH RECURSIVE {LOG}, live AS (SELECT * FROM log WHERE kind NOT IN (5, 62)),
lists AS (SELECT * FROM live WHERE kind = 10040 QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY created_at DESC, id) = 1),
edges AS (SELECT pubkey AS observer, 'u' || (k % 20) AS service, 'wss://r' || (k % 3) || '.example' AS relay, created_at FROM lists UNION ALL SELECT pubkey, 'u' || ((k + 3) % 20), NULL, created_at FROM lists),
homes AS (SELECT service, relay FROM edges WHERE relay IS NOT NULL QUALIFY row_number() OVER (PARTITION BY service ORDER BY created_at DESC, relay) = 1),
scores AS (
  SELECT pubkey AS service, d AS subject FROM live l JOIN homes h ON h.service = l.pubkey AND h.relay = 'wss://r' || (event_id % 3) || '.example' WHERE kind = 30382 AND d <> ''
  QUALIFY row_number() OVER (PARTITION BY pubkey, d ORDER BY created_at DESC, id) = 1),
walk AS (SELECT 'u0' AS observer, 0 AS depth UNION SELECT subject, depth + 1 FROM walk JOIN edges USING (observer) JOIN scores USING (service) WHERE depth < 30 AND subject IN (SELECT observer FROM edges)),
reached AS (SELECT observer, min(depth) AS depth FROM walk GROUP BY 1)
SELECT 'observers' AS what, (SELECT count(*) FROM reached) AS n UNION ALL SELECT 'edges', (SELECT count(*) FROM edges WHERE observer IN (SELECT observer FROM reached)) UNION ALL SELECT 'scores', (SELECT count(*) FROM scores) UNION ALL SELECT 'deep', (SELECT count(*) FROM reached WHERE depth > 1)""",
    "log_geohash_cells": f"WITH {LOG} SELECT id FROM log WHERE m = 2 AND k % 5 IN (1, 4)",
    "log_tag_index": f"WITH {LOG}, t AS (SELECT kind, unnest(CASE WHEN m = 2 THEN ['t', 'g'] WHEN m = 4 THEN ['e'] WHEN m = 5 THEN ['a'] WHEN m = 7 THEN ['r', 'r', 'r'] WHEN m IN (11, 12, 13, 15) THEN ['d'] ELSE [] END) AS letter FROM log) SELECT kind, letter, count(*) AS n FROM t GROUP BY 1, 2",
    "log_profiles": f"WITH {CUR} SELECT pubkey, 'name w' || (k % 7) AS name, CASE WHEN k % 2 = 0 THEN 'shown ' || (k % 3) END AS display_name FROM cur WHERE kind = 0",
    "log_expiring_notes": f"WITH {STORED} SELECT count(*) FILTER (expires_at < {NOW}) AS expired, count(*) FILTER (expires_at = {NOW}) AS now, count(*) FILTER (expires_at > {NOW}) AS later FROM held WHERE kind = 1",
    "log_insert_rules": f"WITH {ARRIVED}, {stored('arrived', 'held')} SELECT kind, count(*) AS n FROM held GROUP BY 1",
    "log_insert_fates": f"""WITH {ARRIVED}, early AS (SELECT * FROM arrived WHERE event_id % 3 <> 0), {stored('early', 'h1')}, {stored('arrived', 'h2')},
twice AS (SELECT * FROM log UNION ALL SELECT * FROM log WHERE event_id % 10 = 0),
n AS (
  SELECT p AS pass, count(*) AS offered, count(*) FILTER (kind = 20001) AS ephemeral, count(*) FILTER (kind <> 20001 AND expires_at <= {NOW}) AS expired,
         count(DISTINCT event_id) FILTER (kind <> 20001 AND (expires_at IS NULL OR expires_at > {NOW})) AS single
  FROM twice, (VALUES (1), (2)) v(p) WHERE p = 2 OR event_id % 3 <> 0 GROUP BY 1),
k AS (SELECT 1 AS pass, 0 AS known, (SELECT count(*) FROM h1) AS stored, 0 AS removed UNION ALL SELECT 2, (SELECT count(*) FROM h1), (SELECT count(*) FROM h2 WHERE id NOT IN (SELECT id FROM h1)), (SELECT count(*) FROM h1 WHERE id NOT IN (SELECT id FROM h2)))
SELECT CAST(pass AS BIGINT) AS pass, offered, ephemeral, expired, offered - ephemeral - expired - single AS duplicate, CAST(known AS BIGINT) AS known, single - known - stored AS refused, stored, CAST(removed AS BIGINT) AS removed FROM n JOIN k USING (pass)""",
    "log_delete_by_filter": f"WITH {LOG} SELECT kind, count(*) AS n FROM log WHERE NOT (kind = 30382 AND pubkey = 'u7') GROUP BY 1",
    "ledger_snapshots": f"WITH {LEDGER} SELECT CASE WHEN content_synced_at > 30000 THEN 5 ELSE content_synced_at END AS content_synced_at, count(*) AS n, CAST(sum(outbox_checked_at) AS BIGINT) AS checked FROM ledger GROUP BY 1",
    "generated_load": "SELECT count(*) AS n, count(*) AS ids, count(DISTINCT o_custkey) AS authors, 1700000000 + max(o_orderkey) AS newest FROM orders",
    "cursor_advance": f"WITH {RUNS}, {CURSORS}, n AS (SELECT relay, scope, max(ended_at) AS new FROM runs WHERE completed GROUP BY 1, 2) SELECT relay, scope, coalesce(new, last_synced_at) AS last_synced_at FROM cursors FULL JOIN n USING (relay, scope)",
    "cursor_since": f"WITH {CURSORS} SELECT p_partkey, coalesce(last_synced_at - 30, CASE WHEN p_size % 2 = 0 THEN p_size END) AS since, last_synced_at IS NULL AS first FROM part LEFT JOIN cursors ON relay = p_partkey % 70 AND scope = {SCOPE}[p_partkey // 70 % 3 + 1]",
    "capability_memory": """WITH r AS (SELECT l_suppkey % 97 AS relay, l_orderkey * 10 + l_linenumber AS ended_at, l_orderkey + l_linenumber + l_partkey AS n FROM lineitem),
o AS (SELECT relay, bool_or(n % 4001 = 0) AS bad FROM r GROUP BY 1), t AS (SELECT relay, n % 5 = 1 AS told FROM r WHERE n % 4001 <> 0 AND n % 5 IN (1, 2) QUALIFY row_number() OVER (PARTITION BY relay ORDER BY ended_at, n % 5 = 1) = 1),
k AS (SELECT s_suppkey AS relay, CASE WHEN s_suppkey % 10 = 0 THEN s_acctbal > 4000 END AS capable FROM supplier WHERE s_suppkey % 5 = 0)
SELECT relay, CASE WHEN bad THEN false ELSE coalesce(capable, told) END AS capable FROM k FULL JOIN (SELECT * FROM o LEFT JOIN t USING (relay)) USING (relay)""",
    "dead_relays": f"""WITH f AS (SELECT user_id % 40 AS relay, CAST(epoch(max(date_trunc('hour', ts))) AS BIGINT) * 1000 + 21600000 AS until FROM events WHERE event_type = 'error' GROUP BY 1),
m AS (SELECT relay, coalesce(until, CASE WHEN n_nationkey IS NOT NULL THEN {NOW}::BIGINT * 1000 + 5 END) AS dead_until FROM f FULL JOIN (SELECT n_nationkey, CAST(n_nationkey AS BIGINT) AS relay FROM nation) USING (relay))
SELECT e.relay, dead_until, dead_until IS NULL AS alive FROM (SELECT DISTINCT user_id % 60 AS relay FROM events) e LEFT JOIN (SELECT * FROM m WHERE dead_until > ({NOW}::BIGINT - 86400) * 1000) USING (relay)""",
    "newest_readings": "SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS at, count(DISTINCT user_id) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 12",
    "readings_rate": "SELECT round((arg_max(o_orderkey * 2 + o_custkey % 2, o_orderkey) - arg_min(o_orderkey * 2 + o_custkey % 2, o_orderkey)) / (max(o_orderkey) - min(o_orderkey)), 9) AS rate FROM orders",
    "pass_totals": "WITH b AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS received, count(DISTINCT user_id) AS stored FROM events GROUP BY 1) SELECT *, CAST(sum(received) OVER (ORDER BY day) AS BIGINT) AS so_far FROM b",
    "completed_authors": "WITH d AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') SELECT false AS new, count(*) AS n FROM d UNION ALL SELECT true, count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM d)",
    "low_yield_discards": "WITH o AS (SELECT o_custkey AS relay, o_orderkey AS batch, o_totalprice < 180000 AND o_orderkey % 9 <> 0 AS low FROM orders WHERE o_custkey % 4 <> 0), i AS (SELECT *, row_number() OVER (PARTITION BY relay ORDER BY batch) - row_number() OVER (PARTITION BY relay, low ORDER BY batch) AS island FROM o), s AS (SELECT relay, island, count(*) AS streak FROM i WHERE low GROUP BY 1, 2 HAVING count(*) >= 2) SELECT relay, max(streak) AS streak FROM s GROUP BY 1",
    "yield_per_author": "SELECT l_suppkey AS relay, count(*) * 7 // count(DISTINCT l_partkey) AS yield FROM lineitem GROUP BY 1",
    "slice_outcomes": "WITH s AS (SELECT o_orderkey % 8, count(*) AS a, count(DISTINCT o_custkey) AS b FROM orders GROUP BY 1) SELECT CAST(sum(a) AS BIGINT) AS downloaded, CAST(sum(b) AS BIGINT) AS stored, count(*) AS slices FROM s",
    "work_position": "WITH d AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) || '/' || count(*) OVER (PARTITION BY l_suppkey) AS position FROM d",
    "settled_downloads": """WITH r AS (SELECT l_orderkey AS n, l_linenumber AS k, l_linenumber = 1 OR l_orderkey % 3 = 2 AS paged FROM lineitem), s AS (SELECT *, NOT paged AND k <> 2 AND (n % 7 > n % 5 OR (n % 5 = 0 AND n % 2 = 0)) AS repaired FROM r)
SELECT CASE WHEN paged THEN 'pages' WHEN repaired THEN 'repaired by pages' ELSE 'reconciled' END AS transport, CASE WHEN paged OR repaired THEN n % 11 <> 0 ELSE n % 13 <> 0 END AS completed, count(*) AS n FROM s GROUP BY 1, 2""",
    "full_listings": """WITH c AS (SELECT relay, relay % 3 <> 0 AND relay % 5 <> 0 AS good FROM (SELECT DISTINCT c_custkey % 35 AS relay FROM customer))
SELECT DISTINCT relay, o_orderkey % 1000 AS id FROM orders JOIN c ON relay = o_custkey % 30 WHERE good UNION ALL SELECT relay, NULL FROM c WHERE NOT good""",
    "relay_author_counts": f"WITH {RELAYS} SELECT relay, count(*) AS authors FROM l GROUP BY 1",
    "observers_by_scores": f"WITH {EDGES} SELECT observer, count(*) AS n FROM edges JOIN lineitem ON l_suppkey = service GROUP BY 1",
    "routing_without_discarded": f"WITH {RELAYS}, t AS (SELECT relay FROM l QUALIFY row_number() OVER (PARTITION BY author ORDER BY relay) <= 4 UNION ALL SELECT 'f0' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) SELECT 'wss://' || relay || '.example' AS relay, count(*) AS n FROM t WHERE relay NOT IN ('r2', 'r5') GROUP BY 1",
    "least_loaded_relays": f"WITH {RELAYS}, c AS (SELECT relay, count(*) AS load FROM l GROUP BY 1) SELECT author, relay FROM l JOIN c USING (relay) QUALIFY row_number() OVER (PARTITION BY author ORDER BY load, relay) = 1",
    "balanced_relays": "SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS authors, CAST(count(DISTINCT o_custkey) AS BIGINT) AS own, true AS even FROM orders",
    "need_have_ranges": "WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus <> 'P' AS here, (o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT') AND NOT (o_orderpriority = '5-LOW' AND o_orderkey % 100 = 0) AS there FROM orders) SELECT id, CASE WHEN here THEN 'have' ELSE 'need' END AS side FROM o WHERE here <> there",
    "identity_sources": """WITH m AS (SELECT c_custkey AS a, 'profile' AS what FROM customer UNION ALL SELECT c_custkey, 'relay list' FROM customer WHERE c_custkey % 2 = 0),
s AS (SELECT what, CASE WHEN what = 'profile' AND a IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 'aggregator' WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = a AND (o_orderkey % 2 = 0) = (what = 'profile')) THEN 'popular' END AS source FROM m)
SELECT what, source, count(*) AS n FROM s GROUP BY 1, 2""",
    "work_map": f"""WITH {EDGES}, e AS (SELECT observer, service, service % 7 AS relay FROM edges), r AS (SELECT relay, 'o' AS t, observer AS w FROM e UNION SELECT relay, 's', service FROM e WHERE service % 2 = 0 UNION SELECT c_custkey % 9, 'a', c_custkey FROM customer UNION SELECT i, 'i', i FROM (VALUES (0), (9)) v(i))
SELECT relay, bool_or(t = 'i') AS sweep, count(*) FILTER (t = 'o') AS outboxes, count(*) FILTER (t = 's') AS services, count(*) FILTER (t = 'a') AS authors FROM r GROUP BY 1""",
    "observer_dot_product": f"WITH {EDGES}, p AS (SELECT observer, l_partkey AS author, max(l_quantity) AS rank FROM edges JOIN lineitem ON l_suppkey = service GROUP BY 1, 2) SELECT author, round(sum(n_nationkey % 3 * 0.5::DOUBLE * rank) / 100, 6) AS trust FROM p JOIN nation ON observer = n_nationkey WHERE n_regionkey < 2 GROUP BY 1",
    "url_normalised": r"SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'wss://relay' || page_id || '.example.com/' ELSE lower(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)) || coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), ''), '/') || regexp_extract(url, '(\?[^#]*)', 1) END AS url FROM pages",
    "format_durations": """WITH o AS (SELECT o_orderkey, o_orderkey * 977 AS n, o_orderkey * 977 // 100 AS s FROM orders)
SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || (s % 3600 // 60) || 'm' WHEN s >= 60 THEN (s // 60) || 'm' ELSE s || 's' END AS age,
       CASE WHEN n < 3600 THEN (n // 60) || 'm' WHEN n < 86400 THEN (n // 3600) || 'h ' || (n % 3600 // 60) || 'm' ELSE (n // 86400) || 'd ' || (n % 86400 // 3600) || 'h' END AS eta,
       format('{:,}', n) AS num, CAST(CASE WHEN o_orderkey % 103 > 0 THEN trunc((o_orderkey % 97)::DOUBLE / (o_orderkey % 103) * 100) ELSE 0 END AS INT) AS pct FROM o""",
    "key_resolution": "SELECT p_partkey, CASE WHEN p_partkey % 14 IN (0, 3, 4, 5, 10, 11) THEN sha256(CAST(p_partkey AS VARCHAR)) END AS key FROM part",
    "place_cells": f"WITH RECURSIVE {PLACES}, points AS (SELECT c_custkey AS id, lat, lon FROM places), {bisected('points', 60)} SELECT id AS c_custkey, {', '.join(f'code[1:{p}] AS p{p}' for p in range(1, 13))} FROM cells",
    "place_cells_near": f"""WITH RECURSIVE {PLACES}, {around(2)}, {around(5)}
SELECT c_custkey, near2, near5 FROM near2 JOIN near5 USING (c_custkey)""",
    "log_line_classes": "SELECT ['phase', 'gauge', 'failure', 'warning', 'done', 'progress', 'tag', 'note', 'failure', 'tag'][o_orderkey % 10 + 1] AS what, count(*) AS n FROM orders GROUP BY 1",
    "status_lines": f"""SELECT o_orderkey, '  ~ relays ' || (o_orderkey % 10) || '/10 | recv ' || {COMPACT.format("(o_orderkey * 100)")} || CASE WHEN o_orderkey % 2 = 1 THEN ' (1.5k/s)' ELSE '' END || ' new ' || {COMPACT.format("(o_orderkey * 10)")} ||
  CASE WHEN o_orderkey % 60 = 0 THEN '' ELSE printf(' | vrf %.1fx wait %.1fx ins %d%%', o_orderkey % 3 / 2, o_orderkey % 5 / 2, o_orderkey % 4 * 25) END AS line FROM orders""",
    "capability_counts": "SELECT count(*) FILTER (s_nationkey % 3 = 1) AS can, count(*) FILTER (s_nationkey % 3 = 2) AS cannot, count(*) FILTER (s_nationkey % 3 = 0) AS unknown FROM supplier",
    "ledger_counts": f"WITH {LEDGER} SELECT count(*) AS n, count(*) FILTER (content_synced_at > 0) AS synced, count(*) FILTER (outbox_checked_at > 0) AS checked FROM ledger",
    "verified_ids": "SELECT 'order ' || o_orderpriority AS content, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1",
    "stream_streaks": """WITH s AS (SELECT user_id, event_type, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
l AS (SELECT user_id, max(island) AS island FROM s GROUP BY 1)
SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'error') >= 2 AS dead FROM l JOIN s USING (user_id, island) GROUP BY 1""",
    "stream_ttl_dead": """WITH e AS (SELECT user_id, date_trunc('millisecond', ts) AS ts, event_id, event_type = 'error' AS bad FROM events),
p AS (SELECT *, lag(ts) OVER w AS before, lag(bad) OVER w AS was FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN bad AND was AND ts - before < INTERVAL 2 DAY THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM p),
l AS (SELECT user_id, island FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, count(*) AS errors, max(ts) + INTERVAL 2 DAY AS dead_until FROM l JOIN s USING (user_id, island) WHERE bad GROUP BY 1
HAVING count(*) >= 2 AND max(ts) + INTERVAL 2 DAY > (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""",
    "stream_late_windows": "SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start, event_type, count(*) AS n, true AS no_more_in_time FROM events GROUP BY 1, 2",
}
