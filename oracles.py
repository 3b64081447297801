"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

_SP = "[ \\t\\n\\r]"
_EPOCH = "'1970-01-01 00:00:00'"
_STAMP = "'2021-03-01 01:23:54'"


_REST = "(?:[ \\t\\n\\r/][^>]*)?(?:>|\\z)"


def _whole(tag: str) -> str:
    return f"<{tag}{_REST}.*?(?:</{tag}{_REST}|\\z)"


_CLOSED = """<[a-zA-Z/!?](?:[^>=]|=[ \\t\\n\\r]*(?:"[^"]*"|''[^'']*''|))*>"""


def _tidy(markup: str) -> str:
    out = f"regexp_replace({markup}, '{_CLOSED}|<[a-zA-Z/!?][^>]*(?:>|\\z)', ' ', 'g')"
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&eacute;", "é"), ("&nbsp;", " "), ("&amp;", "&"),
    ):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '{_SP}+', ' ', 'g'))"


def _without_closed(page: str, tag: str) -> str:
    """Twice the innermost elements out; an opening tag without a closing one keeps its text."""
    for _ in range(2):
        page = f"""array_to_string(list_transform(string_split_regex({page}, '(?i)<{tag}{_REST}'), lambda p, i:
          CASE WHEN i = 1 THEN p WHEN regexp_matches(p, '(?is)</{tag}{_REST}')
               THEN regexp_replace(p, '(?is)^.*?</{tag}{_REST}', ' ') ELSE '<{tag}>' || p END), '')"""
    return page


def _inside(page: str, tag: str) -> str:
    return f"nullif(regexp_extract({page}, '(?is)<{tag}{_REST}(.*?)(?:</{tag}{_REST}|\\z)', 1), '')"


_TOLD = f"""regexp_extract(html, '(?i)<html[^<>]*{_SP}lang=["'']?([a-z]{{2}})', 1)"""
_META = """regexp_extract(html, '(?is)<meta[^<>]*(?:http-equiv=["'']?content-language|name=["'']?lang)["'']?[^<>]*content=["'']?([a-z]{2})', 1)"""
_LANG = f"lower(coalesce(nullif({_TOLD}, ''), nullif({_META}, '')))"
_HIDDEN = f"(?is){_whole('script')}|{_whole('style')}|<!--.*?(?:-->|\\z)"
_MAIN = f"coalesce({_inside('visible', 'article')}, {_inside('visible', 'body')})"


def _articles(at: str) -> str:
    return f"""
WITH english AS (
  SELECT url AS uri, regexp_replace(html, '{_HIDDEN}', ' ', 'g') AS visible
  FROM pages WHERE {_LANG} = 'en'),
found AS (
  SELECT uri, {_tidy(f"coalesce({_inside('visible', 'title')}, {_inside('visible', 'h1')})")} AS title,
         {_tidy(_without_closed(_without_closed(_MAIN, 'nav'), 'footer'))} AS text
  FROM english)
SELECT uri, {at} AS at, title, text,
       CASE WHEN text IS NULL THEN 'Error processing record: Could not parse' END AS error
FROM found"""


_HOSTS = """
SELECT host, count(*) AS count
FROM (SELECT nullif(regexp_extract(url, 'https?://([^ /]*)', 1), '') AS host FROM pages)
WHERE host IS NOT NULL GROUP BY host"""

_SITE = "'https://www.rottentomatoes.com/m/'"

# Score pages: what each layout must give, straight from the events.
_SCORES = f"""
WITH e AS (
  SELECT {_SITE} || 'movie_' || user_id || '/?e=' || event_id AS uri, ts,
         'movie_' || user_id AS name, event_type, event_id, user_id,
         CAST(CAST(floor(value / 5) AS BIGINT) AS VARCHAR) AS critic,
         json_extract_string(props, '$.k') AS k
  FROM events),
r AS (
  SELECT *, CASE WHEN event_type = 'error' THEN 'no score layout'
                 WHEN event_type = 'signup' AND k = '9' THEN 'review count is not a number' END AS reason
  FROM e),
scores AS (
  SELECT uri, ts, name, reason,
         CASE WHEN reason IS NULL THEN critic || CASE WHEN event_type = 'click' THEN '' ELSE '%' END END AS "criticScore",
         CASE WHEN reason IS NULL THEN CASE WHEN event_type IN ('signup', 'purchase') THEN event_id ELSE 0 END END AS "criticNum",
         CASE WHEN reason IS NOT NULL THEN NULL WHEN event_type = 'purchase' THEN 'None'
              WHEN event_type = 'click' THEN k || '0' ELSE k || '0%' END AS "audienceScore",
         CASE WHEN reason IS NULL THEN CASE WHEN event_type = 'signup' THEN user_id ELSE 0 END END AS "audienceNum",
         CASE WHEN reason IS NOT NULL THEN 'Error processing: ' || uri END AS error
  FROM r)"""

_SNAPSHOTS = """
WITH snapshots AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS ts, 'movie_' || user_id AS name,
         CAST(floor(value) AS BIGINT) AS critic, event_id AS "numCritic",
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS audience,
         user_id AS "numAudience"
  FROM events WHERE event_type <> 'error'),
points AS (
  SELECT name, 'critics' AS kind, CAST(ts AS DOUBLE) AS ts, CAST(critic AS DOUBLE) AS score FROM snapshots
  UNION ALL
  SELECT name, 'audience', CAST(ts AS DOUBLE), CAST(audience AS DOUBLE) FROM snapshots),
changes AS (
  SELECT name, kind, count(*) AS points, max(score) - min(score) AS minmax,
         CASE WHEN count(DISTINCT ts) > 1 THEN regr_slope(score, ts) END AS slope
  FROM points GROUP BY name, kind)"""


def _alerts(condition: str) -> str:
    return f"""{_SNAPSHOTS}
SELECT name, kind, points, minmax, round(slope * 1e9, 3) AS slope_e9 FROM changes WHERE {condition}"""


# Transactions of the block payloads, flat.
_TX = """
items AS (
  SELECT 'https://blocks.example.com/' || l_orderkey || '/' || l_linenumber AS uri,
         l_orderkey * 2 AS block, l_linenumber AS line, l_returnflag AS flag,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price, CAST(l_quantity AS BIGINT) AS amount,
         'part-' || l_partkey AS part, 'supp-' || l_suppkey AS supplier, 'shop-' || l_suppkey AS shop,
         CASE WHEN l_returnflag = 'R' THEN 'part-' || l_partkey
              ELSE 'ord-' || l_orderkey || '-' || l_linenumber END AS first,
         CASE WHEN l_returnflag = 'R' THEN 'supp-' || l_suppkey
              ELSE 'ord-' || l_orderkey || '-' || (l_linenumber + 1) END AS second
  FROM lineitem),
tx AS (
  SELECT *, 'minted' AS what, block AS b, 0 AS block_pos, 0 AS tx_pos, 0 AS idx, CAST(0 AS BIGINT) AS fee,
         1 AS n_inputs, 1 AS n_outputs, 'COINBASE' AS addrs, CAST(0 AS BIGINT) AS value,
         'COINBASE' AS payer FROM items
  UNION ALL
  SELECT *, 'spent', block, 0, 1, 1, amount, 3, 4, first || ',' || second, price + amount, first FROM items
  UNION ALL
  SELECT *, 'no_owner', block + 1, 1, 0, NULL, 0, 1, 1, '', 0, NULL FROM items
  UNION ALL
  SELECT *, 'small', block + 1, 1, 1, 2, CASE WHEN flag <> 'N' THEN amount END, 1, 1, first, amount, first FROM items
  UNION ALL
  SELECT *, 'mixed', block + 1, 1, 2, NULL, 0, 2, 1, NULL, NULL, NULL FROM items WHERE line = 7)"""

_GROUPS = """
links AS MATERIALIZED (
  SELECT first AS a, second AS z FROM items UNION SELECT second, first FROM items),
comp(addr, label) USING KEY (addr) AS (
  SELECT a, least(a, min(z)) FROM links GROUP BY a
  UNION
  SELECT l.z, min(c.label) FROM comp c JOIN links l ON l.a = c.addr
  JOIN recurring.comp r ON r.addr = l.z WHERE c.label < r.label GROUP BY l.z),
labels AS (SELECT addr, label FROM comp UNION ALL SELECT 'COINBASE', 'COINBASE'),
positions AS (
  SELECT payer AS addr, b, idx, 0 AS pos FROM tx WHERE idx IS NOT NULL
  UNION ALL
  SELECT second, b, idx, 1 FROM tx WHERE what = 'spent'),
seen AS (SELECT addr, min({'b': b, 'idx': idx, 'pos': pos}) AS place FROM positions GROUP BY addr),
names AS (
  SELECT label, arg_min(addr, {'s': place, 'addr': addr}) AS group_addr
  FROM labels JOIN seen USING (addr) GROUP BY label),
groups AS (SELECT addr, group_addr FROM labels JOIN names USING (label))"""

_LOCATION = """
  SELECT 'crawl/' || l_orderkey || '.warc.gz' AS key, l_linenumber AS n, l_returnflag AS flag,
         l_partkey AS start, CAST(l_quantity AS BIGINT) AS size FROM lineitem"""

ORACLES = {
    "host_distribution": _HOSTS,
    "registry_compose": _HOSTS,
    "copy_projection": f"SELECT url AS uri, {_EPOCH} AS at, html AS content FROM pages",
    "lang_filter": f"SELECT url AS uri, {_LANG} AS lang FROM pages WHERE {_LANG} = 'en'",
    "article_extract": _articles(_EPOCH),
    "incremental_extract": _articles(_EPOCH),
    "archive_articles": _articles(_STAMP),
    "slug_extract": f"""
WITH p AS (
  SELECT p_partkey, replace(p_name, ' ', '_') AS name, p_size FROM part)
SELECT p_partkey,
       CASE WHEN p_size < 10 THEN {_SITE} || name
            WHEN p_size < 20 THEN 'http://rottentomatoes.com/m/' || name || '/?page=2'
            WHEN p_size < 30 THEN {_SITE} || name || '/reviews?type=user'
            WHEN p_size < 40 THEN {_SITE} || name || '?cmp=a/b'
            ELSE 'https://other.example.com/m/' || name || '?x=1' END AS uri,
       CASE WHEN p_size < 40 THEN name ELSE 'https://other.example.com/m/' || name END AS slug
FROM p""",
    "archive_timestamp": """
SELECT o_orderkey,
       CASE o_orderstatus
         WHEN 'F' THEN 'crawl-' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '-00478.warc.gz'
         WHEN 'O' THEN strftime(o_orderdate, '%Y/%m/%d') || '/' || o_custkey || '/' ||
                       (epoch_ms(o_orderdate) + o_custkey) || '_' || o_orderkey || '.warc.gz'
         ELSE 'misc/' || o_orderkey || '.warc.gz' END AS key,
       CASE o_orderstatus
         WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         WHEN 'O' THEN strftime(make_timestamp((epoch_ms(o_orderdate) + o_custkey) * 1000), '%Y-%m-%d %H:%M:%S')
         ELSE '1970-01-01 00:00:00' END AS at
FROM orders""",
    "quarantine_split": f"""
WITH p AS (
  SELECT url, coalesce({_LANG} = 'en', false) AS sound FROM pages),
q AS (SELECT CASE WHEN sound THEN url ELSE replace(url, '://', ':/') END AS uri FROM p),
h AS (SELECT uri, nullif(regexp_extract(uri, 'https?://([^ /]*)', 1), '') AS host FROM q)
SELECT CASE WHEN host IS NULL THEN 'quarantine' ELSE 'good' END AS outcome, uri, host,
       CASE WHEN host IS NULL THEN 'Could not extract domain from ' || uri END AS error
FROM h""",
    "location_index_parse": f"""
WITH l AS ({_LOCATION})
SELECT CASE WHEN n <> 4 THEN key END AS key,
       CASE WHEN n = 1 THEN 0 WHEN n <> 4 THEN start END AS range_start,
       CASE WHEN n NOT IN (1, 2, 4) THEN start + size END AS range_end,
       CASE WHEN n = 4 THEN 'malformed location line: ' || key || ' ' || start || ' ' || size || ' ' || size END AS error
FROM l""",
    "cdx_index_parse": f"""
WITH l AS ({_LOCATION})
SELECT CASE WHEN flag <> 'R' THEN key END AS key,
       CASE WHEN flag <> 'R' THEN start END AS range_start,
       CASE WHEN flag <> 'R' THEN start + size END AS range_end,
       CASE WHEN flag = 'R' THEN 'malformed capture line' END AS error
FROM l""",
    "capture_prefix": f"""
SELECT 'com,rottentomatoes)/m/' || l_partkey AS url_key, {_STAMP} AS at, 'crawl/' || l_orderkey || '.warc.gz' AS key,
       l_partkey AS range_start, l_partkey + CAST(l_quantity AS BIGINT) AS range_end
FROM lineitem WHERE l_returnflag <> 'R' AND starts_with(CAST(l_partkey AS VARCHAR), '1')""",
    "csv_record_scan": """
SELECT url AS uri, strftime(make_timestamp(page_id * 1000000), '%Y-%m-%d %H:%M:%S') AS at, html FROM pages""",
    "encoded_roundtrip": f"""
SELECT url AS uri, {_EPOCH} AS at, html AS content, CAST(NULL AS VARCHAR) AS error FROM pages""",
    "warc_response_scan": f"""
SELECT url AS uri, {_STAMP} AS at, html AS content, CAST(NULL AS VARCHAR) AS error FROM pages""",
    "location_join": """
SELECT url AS uri, html AS content, CAST(NULL AS VARCHAR) AS error FROM pages
UNION ALL SELECT NULL, NULL, 'no such archive' FROM pages WHERE page_id % 10 = 0""",
    "incremental_archives": f"""
SELECT url AS uri, {_STAMP} AS at, html AS content, CAST(NULL AS VARCHAR) AS error FROM pages""",
    "score_extract": f"""{_SCORES}
SELECT uri, "criticScore", "criticNum", "audienceScore", "audienceNum", error, reason FROM scores""",
    "score_clean": f"""{_SCORES}
SELECT CAST(floor(epoch(ts)) AS BIGINT) AS ts, name, CAST(replace("criticScore", '%', '') AS BIGINT) AS critic,
       "criticNum" AS "numCritic", TRY_CAST(replace("audienceScore", '%', '') AS BIGINT) AS audience,
       "audienceNum" AS "numAudience"
FROM scores WHERE reason IS NULL AND "audienceScore" <> 'None'""",
    "score_series": f"""{_SNAPSHOTS}
SELECT name, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS at,
       ts || ';' || critic || ';' || "numCritic" || ';' || audience || ';' || "numAudience" AS point
FROM snapshots""",
    "score_unpack": f"""{_SNAPSHOTS}
SELECT name, ts, critic, "numCritic", audience, "numAudience", CAST(NULL AS VARCHAR) AS error FROM snapshots""",
    "score_pipeline": f"""{_SCORES},
clean AS (
  SELECT name, CAST(replace("criticScore", '%', '') AS DOUBLE) AS critic,
         TRY_CAST(replace("audienceScore", '%', '') AS DOUBLE) AS audience
  FROM scores WHERE reason IS NULL AND "audienceScore" <> 'None'),
points AS (
  SELECT name, 'critics' AS kind, critic AS score FROM clean
  UNION ALL SELECT name, 'audience', audience FROM clean)
SELECT name, kind, count(*) AS points, max(score) - min(score) AS minmax
FROM points GROUP BY name, kind HAVING max(score) - min(score) > 60""",
    "score_delta_slope": _alerts("abs(slope) > 2e-6"),
    "score_delta_minmax": _alerts("minmax > 200"),
    "score_alert_points": f"""{_SNAPSHOTS}
SELECT p.name, p.kind, strftime(make_timestamp(CAST(p.ts AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS at, p.score
FROM points p JOIN changes c USING (name, kind) WHERE kind = 'critics' AND c.minmax > 200""",
    "block_flatten": f"""
WITH {_TX}
SELECT uri, b AS block, block_pos, tx_pos, fee, n_inputs, n_outputs FROM tx""",
    "encoded_blocks": f"""
WITH {_TX}
SELECT b AS block, block_pos, tx_pos, fee, n_inputs, n_outputs, true AS landed_today FROM tx""",
    "txn_inputs": f"""
WITH {_TX}
SELECT uri, b AS block, tx_pos, addrs, value,
       CASE WHEN what = 'mixed' THEN 'Unexpected COINBASE' END AS error FROM tx""",
    "txn_index": f"""
WITH {_TX}
SELECT uri, b AS block, idx, addrs, fee FROM tx WHERE idx IS NOT NULL""",
    "address_groups": f"""
WITH RECURSIVE {_TX}, {_GROUPS}
SELECT addr, group_addr FROM groups""",
    "group_sizes": f"""
WITH RECURSIVE {_TX}, {_GROUPS}
SELECT group_addr, count(*) AS addresses FROM groups GROUP BY group_addr""",
    "txn_edges": f"""
WITH RECURSIVE {_TX}, {_GROUPS},
paid AS (
  SELECT b, idx, payer, first AS out_addr, price AS amount, fee FROM tx WHERE what = 'minted'
  UNION ALL SELECT b, idx, payer, supplier, price, fee FROM tx WHERE what = 'spent'
  UNION ALL SELECT b, idx, payer, part, line, fee FROM tx WHERE what = 'spent'
  UNION ALL SELECT b, idx, payer, shop, amount, fee FROM tx WHERE what = 'small')
SELECT b AS block, idx, group_addr, out_addr, amount, fee
FROM paid JOIN groups ON groups.addr = paid.payer
WHERE fee IS NOT NULL AND amount > 0""",
    "ledger_quarantine": f"""
WITH {_TX}
SELECT uri, b AS block, 'Unexpected COINBASE' AS error FROM tx WHERE what = 'mixed'
UNION ALL
SELECT 'https://blocks.example.com/broken/' || o_orderkey, NULL, 'not a block payload'
FROM orders WHERE o_orderstatus = 'P'""",
}
ORACLES["encoded_stream"] = ORACLES["encoded_roundtrip"]
ORACLES["failure_counts"] = f"""{_SCORES}
SELECT 'rows' AS reason, count(*) AS n FROM scores
UNION ALL SELECT 'failed', count(reason) FROM scores
UNION ALL SELECT 'no score layout', count(*) FILTER (reason = 'no score layout') FROM scores
UNION ALL SELECT 'review count is not a number', count(*) FILTER (reason = 'review count is not a number') FROM scores
UNION ALL SELECT 'other', 0"""
ORACLES["score_report"] = f"""{_SNAPSHOTS}
SELECT p.name || ' (' || p.kind || '): minmax=' || c.minmax::BIGINT || ' at=' ||
       strftime(make_timestamp(CAST(p.ts AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') || ' score=' || p.score::BIGINT AS line
FROM points p JOIN changes c USING (name, kind) WHERE kind = 'critics' AND c.minmax > 200"""
ORACLES["warc_source_scan"] = ORACLES["warc_response_scan"]
ORACLES["groups_merged"] = ORACLES["address_groups"]
ORACLES["score_delta_merged"] = f"""{_SNAPSHOTS}
SELECT 'slope' AS measure, name, kind, points, minmax, round(slope * 1e9, 3) AS slope_e9 FROM changes
WHERE abs(slope) > 2e-6
UNION ALL
SELECT 'minmax', name, kind, points, minmax, round(slope * 1e9, 3) FROM changes WHERE minmax > 200"""
ORACLES["edge_files"] = ORACLES["txn_edges"]
