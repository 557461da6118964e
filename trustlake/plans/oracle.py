"""DuckDB SQL of the report queries."""

EDGES = "edges AS (SELECT s_nationkey AS observer, s_suppkey AS service, n_regionkey AS relay FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0)"
LEDGER = "ledger AS (SELECT p_partkey AS pubkey, CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size * 1000 END AS BIGINT) AS content_synced_at, CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 1000 + 1 END AS BIGINT) AS outbox_checked_at FROM part)"
AUTHORITY = r"lower(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1))"
PATH = r"rtrim(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/')"
HASH = "(list_reduce(list_prepend(0::BIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), lambda a, x: (a * 31 + x) % 4294967296) & 2147483647)"

HOSTS = "['10.0.1.24:4848', 'localhost:1', '100.103.119.73', 'x.onion', '172.16.5.5', '13.50.72.62', '10up.io', '127.example.com', '0.1.2.3', '172.32.0.1', 'a.local', '127.0.0.1', '100.128.0.1', '192.168.7.7:80', '169.254.1.1', '192.169.0.1']"
ROUTABLE = f"""
WITH h AS (SELECT page_id, url, split_part(({HOSTS})[page_id % 16 + 1], ':', 1) AS host FROM pages),
o AS (SELECT *, regexp_full_match(host, '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}') AS address, TRY_CAST(split_part(host, '.', 1) AS INT) AS a, TRY_CAST(split_part(host, '.', 2) AS INT) AS b FROM h)
SELECT page_id, NOT (host = 'localhost' OR ends_with(host, '.local') OR ends_with(host, '.onion') OR address AND (a IN (10, 127) OR (a = 192 AND b = 168) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 100 AND b BETWEEN 64 AND 127))) AS local, true AS own FROM o"""

ORACLE = {
    "filter_kinds_authors_since": "SELECT event_id, user_id, event_type, ts, value FROM events WHERE event_type IN ('click', 'view') AND user_id BETWEEN 0 AND 39 AND ts BETWEEN '2024-01-05' AND '2024-01-25'",
    "filter_tags_any_all": "SELECT event_id, CAST(props->>'$.k' AS INT) AS k, event_type FROM events WHERE CAST(props->>'$.k' AS INT) IN (1, 2, 3, 5, 8, 13) AND event_type IN ('click', 'purchase')",
    "filter_empty_list": "SELECT count(*) AS n FROM events WHERE false",
    "filter_newest_limit": "SELECT event_id, ts FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id LIMIT 25",
    "filter_many_authors": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY 1",
    "content_excluding_plumbing": "SELECT count(*) AS n, count(DISTINCT user_id) AS authors, round(count(*) / count(DISTINCT user_id), 6) AS per_author FROM events WHERE event_type NOT IN ('error', 'signup')",
    "expired_unswept": "WITH e AS (SELECT event_type, CASE WHEN CAST(props->>'$.k' AS INT) % 4 = 0 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) + to_days(CAST(props->>'$.k' AS INT)) END AS x FROM events) SELECT event_type, count(*) FILTER (x < TIMESTAMP '2024-01-31') AS expired, count(*) FILTER (x IS NULL OR NOT x <= TIMESTAMP '2024-01-31') AS visible FROM e GROUP BY 1",
    "kind_histogram_top_other": "WITH b AS (SELECT p_type AS kind, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, kind) AS nth FROM b) SELECT CASE WHEN nth <= 12 THEN kind ELSE 'other' END AS label, CAST(sum(n) AS BIGINT) AS n, count(*) AS kinds FROM r GROUP BY 1",
    "supersede_replaceable": "SELECT user_id, event_type, event_id, ts FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND (f.ts > e.ts OR (f.ts = e.ts AND f.event_id < e.event_id)))",
    "supersede_addressable": "SELECT l_suppkey AS service, l_partkey AS subject, l_quantity AS rank, l_shipdate AS created_at FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_quantity) = 1",
    "rank_max_by_subject": "SELECT l_partkey AS subject, max(l_quantity) AS rank FROM lineitem GROUP BY 1",
    "services_single_relay": f"WITH {EDGES} SELECT service, min(relay) AS relay FROM edges GROUP BY 1 HAVING count(DISTINCT relay) = 1",
    "orphan_scores": f"WITH {EDGES} SELECT l_suppkey AS service, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM edges WHERE service = l_suppkey) GROUP BY 1",
    "scores_attributed_total": f"WITH {EDGES}, k AS (SELECT l_suppkey IN (SELECT service FROM edges) AS known FROM lineitem) SELECT count(*) AS total, count(*) FILTER (known) AS attributed, count(*) FILTER (NOT known) AS orphaned FROM k",
    "scores_per_observer": f"WITH {EDGES}, c AS (SELECT observer, (SELECT count(*) FROM lineitem WHERE l_suppkey IN (SELECT service FROM edges f WHERE f.observer = e.observer)) AS n FROM (SELECT DISTINCT observer FROM edges) e) SELECT * FROM c WHERE n > 0 OR observer = 0",
    "observer_names": f"WITH {EDGES}, n AS (SELECT n_nationkey AS observer, coalesce(CASE WHEN n_regionkey = 1 THEN '  ' WHEN n_regionkey <> 2 THEN n_name END, CASE WHEN n_regionkey IN (1, 2) THEN CASE WHEN n_regionkey = 2 THEN 'shown ' ELSE '' END || n_name END) AS name FROM nation WHERE n_nationkey % 7 <> 0) SELECT DISTINCT observer, CASE WHEN trim(name) <> '' THEN name ELSE '(no profile)' END AS name FROM edges LEFT JOIN n USING (observer)",
    "observer_roster": f"WITH {EDGES} SELECT DISTINCT observer, l_partkey AS subject FROM edges JOIN lineitem ON service = l_suppkey",
    "observer_coverage": f"WITH {EDGES}, {LEDGER}, r AS (SELECT DISTINCT observer, l_partkey AS subject FROM edges JOIN lineitem ON service = l_suppkey), f AS (SELECT observer, count(*) AS roster, count(*) FILTER (subject IN (SELECT c_custkey FROM customer)) AS with_own_outbox, count(*) FILTER (content_synced_at >= 1) AS synced, count(*) FILTER (coalesce(content_synced_at, 0) < 1 AND coalesce(outbox_checked_at, 0) = 0) AS unreached FROM r LEFT JOIN ledger ON subject = pubkey GROUP BY 1), p AS (SELECT observer, count(DISTINCT service) AS providers FROM edges GROUP BY 1) SELECT p.observer, providers, coalesce(roster, 0) AS roster, coalesce(with_own_outbox, 0) AS with_own_outbox, coalesce(synced, 0) AS synced, coalesce(unreached, 0) AS unreached, greatest(coalesce(roster - synced, 0), 0) AS pending, greatest(greatest(coalesce(roster - synced, 0), 0) - coalesce(unreached, 0), 0) AS attempted, CASE WHEN roster > 0 THEN round(synced / roster, 6) ELSE 0.0 END AS fraction FROM p LEFT JOIN f USING (observer)",
    "stale_ids_absence_delete": "SELECT service, count(*) AS n FROM (SELECT l_suppkey AS service, max(l_quantity) AS best FROM lineitem GROUP BY l_orderkey, l_linenumber, l_suppkey, l_partkey) WHERE best <= 5 GROUP BY 1",
    "need_have_diff": "SELECT CASE WHEN o_orderstatus = 'P' THEN 'need' ELSE 'have' END AS side, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders WHERE (o_orderstatus <> 'P') <> (o_orderpriority <> '5-LOW') GROUP BY 1",
    "missing_identity": "WITH r AS (SELECT o_custkey AS author FROM orders UNION SELECT c_custkey FROM customer) SELECT author, 'profile' AS missing FROM r WHERE author NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT author, 'relay list' FROM r WHERE author NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "content_routing": f"WITH l AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS author, 'wss://r' || (o_orderkey % 7) || '.example' AS relay FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 5 <> 0), k AS (SELECT author, relay FROM l QUALIFY row_number() OVER (PARTITION BY author ORDER BY relay) <= 4), c AS (SELECT CAST(c_custkey AS VARCHAR) AS author FROM customer) SELECT k.author, relay FROM k JOIN c USING (author) UNION ALL SELECT author, 'wss://fallback' || CAST(({HASH.format('author')} % 8 + i) % 8 AS VARCHAR) || '.example' FROM c, (VALUES (0), (1)) v(i) WHERE author NOT IN (SELECT author FROM l)",
    "fallback_hash_spread": f"SELECT page_id, CAST({HASH.format('url')} % 8 AS BIGINT) AS slot FROM pages",
    "popular_relays_top15": "SELECT c_nationkey AS relay, count(DISTINCT c_custkey) AS authors FROM customer WHERE c_nationkey NOT IN (0, 1) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "author_batches_500": "WITH a AS (SELECT DISTINCT l_suppkey % 10 AS relay, l_partkey AS author FROM lineitem), n AS (SELECT *, (row_number() OVER (PARTITION BY relay ORDER BY author) - 1) // 500 AS batch FROM a) SELECT relay, batch, count(*) AS n, min(author) AS first, max(author) AS last FROM n GROUP BY 1, 2",
    "refresh_slice": f"WITH {LEDGER} SELECT pubkey, content_synced_at FROM ledger WHERE content_synced_at BETWEEN 1 AND 20000 ORDER BY 2, 1 LIMIT 40",
    "ttl_backlog_ranked": f"WITH {LEDGER} SELECT p_partkey AS subject, coalesce((SELECT max(l_quantity) FROM lineitem WHERE l_partkey = p_partkey), 0.0) AS rank FROM part WHERE p_partkey NOT IN (SELECT pubkey FROM ledger WHERE content_synced_at >= 30000)",
    "ledger_upsert": f"WITH {LEDGER} SELECT pubkey, CASE WHEN content_synced_at > 30000 THEN 5 ELSE content_synced_at END AS content_synced_at, outbox_checked_at FROM ledger",
    "synced_rate_eta": "WITH s AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS c, ts FROM events), r AS (SELECT event_id, t - first_value(t) OVER w AS span, c - first_value(c) OVER w AS more FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)), q AS (SELECT event_id, CASE WHEN span > 0 THEN round(more / span, 9) END AS rate FROM r) SELECT event_id, rate, CAST(floor(1000 / nullif(rate, 0)) AS BIGINT) AS eta FROM q",
    "tick_rates": "WITH b AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM events GROUP BY 1) SELECT day, n, n - lag(n) OVER (ORDER BY day) AS delta FROM b",
    "low_yield_streak": "WITH o AS (SELECT o_custkey AS relay, o_orderkey AS batch, o_totalprice < 100000 AS low FROM orders), i AS (SELECT *, row_number() OVER (PARTITION BY relay ORDER BY batch) - row_number() OVER (PARTITION BY relay, low ORDER BY batch) AS island FROM o), s AS (SELECT relay, island, count(*) AS streak FROM i WHERE low GROUP BY 1, 2) SELECT relay, max(streak) AS streak FROM s WHERE streak >= 2 GROUP BY 1",
    "idle_gap_sessions": "WITH s AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) SELECT user_id, count(*) FILTER (b IS NULL OR ts > b + INTERVAL 30 MINUTE) AS sessions, count(*) AS events FROM s GROUP BY 1",
    "cursor_scope_keys": "SELECT p_partkey, CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN ':' || CAST(p_partkey AS VARCHAR) ELSE '' END AS scope, p_partkey * 100 - 3600 AS since FROM part",
    "incomplete_sync_flag": "SELECT l_returnflag, count(*) FILTER (l_returnflag <> 'N' AND l_linenumber <> 7 AND l_quantity > 25) AS incomplete, count(*) AS n FROM lineitem GROUP BY 1",
    "url_authority_path": f"SELECT page_id, {AUTHORITY} AS authority, {PATH} || regexp_extract(url, '([?][^#]*)', 1) AS path FROM pages",
    "url_publicly_routable": ROUTABLE,
    "url_collapse": f"WITH p AS (SELECT page_id, {AUTHORITY} AS authority, {PATH} AS path FROM pages) SELECT a.page_id, arg_min(b.path, (length(b.path), b.path)) AS kept FROM p a JOIN p b ON a.authority = b.authority AND (b.path = '' OR b.path = a.path OR starts_with(a.path, b.path || '/')) GROUP BY 1",
    "format_compact": "WITH n AS (SELECT o_orderkey, o_orderkey * 137 AS n FROM orders), t AS (SELECT *, (n * 10 + 500) // 1000 AS k, (n * 10 + 500000) // 1000000 AS m FROM n) SELECT o_orderkey, CASE WHEN n >= 10000000 THEN CAST(n // 1000000 AS VARCHAR) || 'M' WHEN n >= 1000000 THEN CAST(m // 10 AS VARCHAR) || '.' || CAST(m % 10 AS VARCHAR) || 'M' WHEN n >= 100000 THEN CAST(n // 1000 AS VARCHAR) || 'k' WHEN n >= 1000 THEN CAST(k // 10 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR) || 'k' ELSE CAST(n AS VARCHAR) END AS text FROM t",
    "format_age_ago": "WITH s AS (SELECT o_orderkey, o_orderkey * 29 AS s FROM orders) SELECT o_orderkey, CASE WHEN s < 60 THEN s || 's ago' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's ago' WHEN s < 86400 THEN s // 3600 || 'h ' || s % 3600 // 60 || 'm ago' ELSE s // 86400 || 'd ' || s % 86400 // 3600 || 'h ago' END AS text FROM s",
    "kind_labels": "SELECT event_type, CASE event_type WHEN 'view' THEN 'views' WHEN 'click' THEN 'clicks' WHEN 'error' THEN 'errors' ELSE 'kind ' || event_type END AS label, count(*) AS n FROM events GROUP BY 1",
    "config_list_parse": "SELECT p_partkey, trim(p_brand) || '|' || trim(p_type) AS items, greatest(p_size, 5) AS width FROM part",
    "search_strip_extensions": r"SELECT p_partkey, array_to_string(list_filter(string_split(lower(p_type) || ' language:en filter:rank:30', ' '), lambda x: NOT regexp_full_match(x, '\w+:\S+') AND x <> ''), ' ') AS terms FROM part",
    "search_raw_count": r"SELECT lang, count(*) AS n FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}]+'), 'the') GROUP BY 1",
    "search_bm25_trust": r"WITH w AS (SELECT doc_id AS id, source AS author, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS words FROM documents), s AS (SELECT count(*) AS docs, avg(len(words)) AS mean FROM w), t AS (SELECT id, author, len(words) AS n, unnest(words) AS term FROM w), h AS (SELECT id, author, n, term, count(*) AS tf FROM t WHERE term IN ('the', 'idiot', 'von') GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM h GROUP BY 1), b AS (SELECT id, author, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean))) AS bm25, (length(author) * 7 + ascii(substr(author, 4, 1))) % 10 / 10.0::DOUBLE AS trust FROM h JOIN f USING (term), s GROUP BY id, author) SELECT id, author, round(bm25 * (1 + trust), 6) AS score FROM b WHERE trust >= 0.3::DOUBLE ORDER BY score DESC, id LIMIT 500",
    "delete_explicit": "WITH g AS (SELECT event_id - CAST(props->>'$.k' AS BIGINT) AS event_id, user_id % 10 AS digit FROM events WHERE event_type = 'error') SELECT event_type, count(*) AS n FROM events e WHERE event_type <> 'error' AND NOT EXISTS (SELECT 1 FROM g WHERE g.event_id = e.event_id AND g.digit = e.user_id % 10) GROUP BY 1",
    "vanish_inclusive": "SELECT user_id, count(*) AS n FROM events e WHERE event_type = 'signup' OR NOT EXISTS (SELECT 1 FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'signup' AND v.ts >= e.ts) GROUP BY 1",
    "time_slices": "SELECT least(7, (event_id - (SELECT min(event_id) FROM events)) * 8 // ((SELECT max(event_id) - min(event_id) + 1 FROM events))) AS slice, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1",
    "first_success_union": "SELECT o_custkey AS author, o_orderpriority AS source, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) = 1",
    "roster_union": f"WITH {EDGES} SELECT 'p' AS what, count(DISTINCT l_partkey) AS n FROM lineitem UNION ALL SELECT 'o', count(DISTINCT observer) FROM edges UNION ALL SELECT 's', count(DISTINCT service) FROM edges",
    "observer_frontier": f"WITH RECURSIVE {EDGES}, links AS (SELECT DISTINCT e.observer, CAST(l_partkey AS INT) AS subject FROM edges e JOIN lineitem ON service = l_suppkey WHERE l_partkey IN (SELECT observer FROM edges)), walk AS (SELECT 0 AS observer, 0 AS depth UNION SELECT subject, depth + 1 FROM walk JOIN links USING (observer) WHERE depth < 12) SELECT observer, min(depth) AS depth FROM walk GROUP BY 1",
    "cursor_freshness": "WITH u AS (SELECT user_id, max(event_id) AS cursor, arg_max(event_type, (ts, event_id)) AS last FROM events GROUP BY 1) SELECT min(cursor) AS oldest, max(cursor) AS newest, count(*) FILTER (last = 'view') AS capable FROM u",
    "relay_work_map": f"WITH {EDGES} SELECT relay, count(DISTINCT observer) AS observers, array_to_string(list_transform(list_sort(list(DISTINCT service)), lambda x: CAST(x AS VARCHAR)), ',') AS services FROM edges GROUP BY 1",
    "oldest_newest": "SELECT event_type, min(ts) AS oldest, max(ts) AS newest FROM events GROUP BY 1",
    "absent_everywhere": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority = '5-LOW' GROUP BY 1",
    "busiest_downloads": "WITH c AS (SELECT l_suppkey AS s, count(*) AS n FROM lineitem GROUP BY 1) (SELECT 'service ' || s AS label, n FROM c ORDER BY n DESC, s LIMIT 3) UNION ALL SELECT '+' || greatest(count(*) - 3, 0) || ' more', greatest(count(*) - 3, 0) FROM c",
    "trust_bands": "WITH b AS (SELECT l_suppkey AS service, l_partkey AS subject, max(l_quantity) AS rank FROM lineitem GROUP BY 1, 2), t AS (SELECT *, ntile(4) OVER (PARTITION BY service ORDER BY rank DESC, subject) AS band FROM b) SELECT service, band, count(*) AS n, min(rank) AS least, max(rank) AS most FROM t GROUP BY 1, 2",
    "insert_if_missing": "SELECT c_custkey AS author, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)",
    "services_covered": f"WITH {EDGES} SELECT observer, bool_and(service % 9 <> 0) AS covered FROM edges GROUP BY 1",
    "download_labels": "WITH b AS (SELECT user_id AS u, event_type, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2) SELECT u AS user_id, event_type, 'r' || (u % 5) || '.example k' || u || ' author' || lpad(CAST(u AS VARCHAR), 6, '0')[1:2] || CASE WHEN u % 3 = 0 AND u % 2 = 1 THEN '' ELSE ' ' || CASE WHEN u % 3 <> 0 THEN strftime(a, '%m-%d') ELSE chr(8230) END || '..' || CASE WHEN u % 2 = 0 THEN strftime(b, '%m-%d') ELSE chr(8230) END END AS label FROM b",
    "stream_dedup": "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1",
    "stream_tumbling_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
