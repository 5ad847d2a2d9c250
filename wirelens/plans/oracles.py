"""DuckDB SQL of the queries, for the driver's comparison."""

from __future__ import annotations

from ..functions.constants import DEAL_TYPES, FALSE_POSITIVE_VERDICTS, PRESS_PATHS, STOP_TOKENS

_FP = ", ".join(f"'{v}'" for v in FALSE_POSITIVE_VERDICTS)
_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_TOKENS) + "]"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _norm(c: str) -> str:
    bare = rf"regexp_replace({_strip(f"lower(coalesce({c}, ''))")}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return rf"regexp_replace({bare}, '\s+', ' ', 'g')"


def _words(c: str) -> str:
    return f"list_filter(string_split({_norm(c)}, ' '), lambda w: length(w) > 1)"


def _tokens(c: str) -> str:
    return f"list_distinct(list_filter({_words(c)}, lambda w: NOT list_contains({_STOP}, w)))"


def _acronym(c: str) -> str:
    return f"CASE WHEN len({_words(c)}) >= 2 THEN array_to_string(list_transform({_words(c)}, lambda w: w[1]), '') ELSE '' END"


_RULES = """
MATERIALIZED (
  SELECT *, list_filter(t1, lambda x: NOT list_contains(ts, x)) AS l, list_filter(t2, lambda x: NOT list_contains(ts, x)) AS r,
         {strip1} AS b1, {strip2} AS b2
  FROM pairs
)""".replace("{strip1}", _strip("replace(n1, ns, '')")).replace("{strip2}", _strip("replace(n2, ns, '')"))

#: Over pairs with n1, n2, ns (normalized), t1, t2, ts (tokens), a1, a2 (acronyms); one seller on both sides.
_MATCH = """(
  n1 = n2
  OR (len(list_intersect(l, r)) > 0 AND (len(list_intersect(l, r)) >= 2 OR 2 * len(list_intersect(l, r)) >= len(list_distinct(list_concat(l, r)))))
  OR (b1 <> '' AND b2 <> '' AND (contains(b2, b1) OR contains(b1, b2)))
  OR (length(ns) >= 5 AND starts_with(n1, left(ns, 4)) AND starts_with(n2, left(ns, 4)))
  OR (len(ts) > 0 AND (len(l) = 0 OR len(r) = 0))
  OR (a1 <> '' AND a1 = a2)
  OR (a1 <> '' AND (starts_with(replace(n2, ' ', ''), a1) OR list_contains(t2, a1)))
  OR (a2 <> '' AND (starts_with(replace(n1, ' ', ''), a2) OR list_contains(t1, a2)))
)"""

_VERDICTS = """
rows AS (
  SELECT d.doc_id, text AS title, CASE WHEN quality IS NULL THEN 'Pending' WHEN quality = 1 THEN 'Confirmed' WHEN toxic = 1 THEN 'Not Relevant' ELSE 'Low EV' END AS verdict,
         CASE WHEN regexp_extract(source, '([0-9]+)', 1)::INT % 3 = 0 THEN '' WHEN regexp_extract(source, '([0-9]+)', 1)::INT % 2 = 0 THEN 'corporate_carveout' ELSE 'portco_carveout' END AS deal_type,
         CASE lang WHEN 'en' THEN 'pursue' WHEN 'de' THEN 'monitor' ELSE '' END AS action, n_chars::VARCHAR AS score
  FROM documents d LEFT JOIN labels USING (doc_id)
)"""
_FPS = f"fp AS (SELECT * FROM rows WHERE verdict IN ({_FP}))"

_EVENT_URLS = "e AS (SELECT event_id, user_id::VARCHAR || '/' || event_type AS url, ts, event_type, value FROM events)"
_OUTCOMES = """
log AS (SELECT event_id, ts, user_id AS firm, CASE event_type WHEN 'error' THEN '404' WHEN 'purchase' THEN 'ok' WHEN 'signup' THEN 'ok' WHEN 'view' THEN 'timeout' ELSE '403' END AS outcome FROM events),
runs AS (SELECT *, sum((outcome = 'ok')::INT) OVER (PARTITION BY firm ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM log),
streaks AS (SELECT *, sum((outcome = '404')::INT) OVER (PARTITION BY firm, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak FROM runs),
errors AS (
  SELECT firm, arg_max(streak, (ts, event_id)) AS consecutive_404s, max(streak) >= 3 AS needs_url_update, arg_max(outcome, (ts, event_id)) AS last_outcome,
         arg_max(outcome, (ts, event_id)) FILTER (outcome <> 'ok') AS last_error, bool_or(outcome = '403') AS prefer_render
  FROM streaks GROUP BY firm
)"""
_FIRMS = """
firms AS (
  SELECT s_suppkey, s_name AS name, 'www.' || lower(replace(s_name, '#', '')) || '.example.com' AS domain, CASE WHEN s_suppkey % 3 = 0 THEN 'https://feed/' || s_suppkey END AS feed_url,
         CASE WHEN s_suppkey % 4 <> 0 THEN 'https://press/' || s_suppkey END AS press_url
  FROM supplier
)"""
_DEALS = """
deals AS (
  SELECT p_partkey AS ord, CASE p_partkey % 7 WHEN 0 THEN replace(p_brand, '#', '') || ' Tech' WHEN 1 THEN 'Industrial Division' WHEN 2 THEN upper(p_name) WHEN 3 THEN p_name || ' products unit' ELSE p_type || ' ' || p_name END AS target,
         replace(p_brand, '#', '') || ' Holdings' AS seller, CASE WHEN p_size % 2 = 0 THEN 'signing' ELSE 'closing' END AS stage
  FROM part
)"""
_SIDES = f"""
names AS (SELECT DISTINCT seller, stage, target FROM deals),
side AS MATERIALIZED (SELECT *, {_norm('target')} AS n, {_tokens('target')} AS t, {_acronym('target')} AS a, {_norm('seller')} AS ns, {_tokens('seller')} AS ts FROM names)"""
_LINKED = """
linked AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '<link rel=''alternate'' type=''application/rss+xml'' href=''/feed/' || page_id || '.xml''>' ELSE '' END
         || CASE WHEN page_id % 3 = 0 THEN '<a href="/news/0/' || page_id || '">n</a><a href="/news/1/' || page_id || '">n</a><a href="/news/2/' || page_id || '">n</a>' ELSE '' END || html AS body
  FROM pages
)"""
_ALERTS = """
alerts AS (
  SELECT o_orderkey AS ord, ' Deal ' || o_orderkey || ' ' AS title, 'https://x.example.com/' || o_orderkey AS url, o_orderdate AS published,
         CASE o_orderkey % 3 WHEN 0 THEN 'corporate_carveout' WHEN 1 THEN 'portco_carveout' END AS deal_type, o_orderkey % 3 <> 2 AS is_carveout,
         CASE o_orderstatus WHEN 'O' THEN 'signing' WHEN 'F' THEN 'closing' END AS stage, 'Target ' || (o_orderkey % 17) AS target_company,
         CASE o_orderkey % 11 WHEN 0 THEN '  ' WHEN 1 THEN 'Unknown parent' WHEN 2 THEN 'n/a' ELSE 'Seller ' || (o_orderkey % 40) END AS seller,
         CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'Buyer' END AS buyer, 'because' AS reasoning, (o_orderkey % 101)::INT AS confidence, (o_orderkey % 97)::INT AS raw_fit,
         CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey % 10)::INT END AS pe_buyer, (o_orderkey % 7)::INT AS separation_complexity, o_orderpriority AS firm_name
  FROM orders
), capped AS (
  SELECT *, CASE WHEN coalesce(pe_buyer, 0) = 0 THEN least(raw_fit, 30) ELSE raw_fit END AS fit1 FROM alerts
), scored AS (
  SELECT *, (CASE WHEN separation_complexity = 0 THEN least(fit1, 25) ELSE fit1 END)::INT AS fit,
         CASE WHEN coalesce(pe_buyer, 0) = 0 OR separation_complexity = 0 THEN 'discard' WHEN raw_fit >= 65 THEN 'pursue' WHEN raw_fit >= 40 THEN 'monitor' ELSE 'discard' END AS recommended_action
  FROM capped
)"""
_SOLD = "trim(seller) <> '' AND NOT starts_with(lower(trim(seller)), 'unknown') AND lower(trim(seller)) <> 'n/a'"
_BATCHED = "numbered AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS i FROM documents)"
_CAP = r"CASE WHEN len(w) > 1500 THEN array_to_string(w[1:1500], ' ') ELSE text END[1:6000]"
_SPLIT = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"

#: Whether representative r and the next row p (structs with n, t, a, solid, ns, ts) are one deal.
_SAME = """(
  (len(r.ts) = 0 OR len(p.ts) = 0 OR list_has_any(r.ts, p.ts)) AND (
    r.n = p.n OR (r.a <> '' AND r.a = p.a)
    OR (length(r.ns) >= 5 AND starts_with(r.n, left(r.ns, 4)) AND starts_with(p.n, left(r.ns, 4)))
    OR (length(p.ns) >= 5 AND starts_with(r.n, left(p.ns, 4)) AND starts_with(p.n, left(p.ns, 4)))
    OR (r.a <> '' AND (starts_with(p.solid, r.a) OR list_contains(p.t, r.a))) OR (p.a <> '' AND (starts_with(r.solid, p.a) OR list_contains(r.t, p.a)))
    OR len(list_intersect({l}, {q})) >= 2
    OR (len(list_intersect({l}, {q})) > 0 AND 2 * len(list_intersect({l}, {q})) >= len(list_distinct(list_concat({l}, {q}))))
    OR ((len({l}) = 0 OR len({q}) = 0) AND list_has_any(r.ts, p.ts))
    OR ({b1} <> '' AND {b2} <> '' AND (contains({b2}, {b1}) OR contains({b1}, {b2})))
  ))""".format(
    l="list_filter(r.t, lambda x: NOT list_contains(r.ts, x) AND NOT list_contains(p.ts, x))", q="list_filter(p.t, lambda x: NOT list_contains(r.ts, x) AND NOT list_contains(p.ts, x))",
    b1="trim(replace(trim(replace(r.n, r.ns, '')), p.ns, ''))", b2="trim(replace(trim(replace(p.n, r.ns, '')), p.ns, ''))",
)

#: folded: what stays of fold_in (block, ord, title, target, seller, conf, reasoning), row after row in order.
_FOLD = rf"""
profiled AS MATERIALIZED (
  SELECT block, k, {{'ord': ord, 'title': title, 'target': target, 'seller': seller, 'conf': conf, 'reasoning': reasoning, 'n': n, 't': t, 'a': a,
                     'solid': regexp_replace(n, '[^\p{{L}}\p{{N}}_]', '', 'g'), 'ns': ns, 'ts': ts}} AS p
  FROM (SELECT *, row_number() OVER (PARTITION BY block ORDER BY ord) AS k, {_norm('target')} AS n, {_tokens('target')} AS t, {_acronym('target')} AS a, {_norm('seller')} AS ns, {_tokens('seller')} AS ts FROM fold_in)
), state AS (
  SELECT block, k, [p] AS reps FROM profiled WHERE k = 1
  UNION ALL
  SELECT block, k, CASE WHEN i IS NULL OR i = 0 THEN list_append(reps, p) ELSE list_concat(reps[1:i - 1], [CASE WHEN p.conf > reps[i].conf
           THEN struct_update(p, reasoning := p.reasoning || chr(10) || '[Also: ' || reps[i].title || ']')
           ELSE struct_update(reps[i], reasoning := reps[i].reasoning || chr(10) || '[Also: ' || p.title || ']') END], reps[i + 1:]) END
  FROM (SELECT s.block, x.k, s.reps, x.p, list_position(list_transform(s.reps, lambda r: {_SAME}), true) AS i FROM state s JOIN profiled x ON x.block = s.block AND x.k = s.k + 1)
), folded AS (SELECT block, unnest(reps) AS r FROM (SELECT block, arg_max(reps, k) AS reps FROM state GROUP BY block))"""

def _plain(x: str) -> str:
    """Text with its entities read."""
    for name, value in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#x27;", "chr(39)"), ("&amp;", "'&'"), ("&amp", "'&'")):
        x = f"replace({x}, '{name}', {value})"
    return x


#: Over pages whose article holds a heading and paragraphs alone, and whose list items hold the links, as in the test tables.
_BODIES = rf"""
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
p AS (
  SELECT page_id, array_to_string(list_filter(list_transform(regexp_split_to_array(h, '<[^>]*>'), lambda x: {_strip(_plain('x'))}), lambda x: x <> ''), ' ') AS whole,
         list_transform(string_split(h, '<p>')[2:], lambda x: {_plain("regexp_replace(x, '<[^>]*>', '', 'g')")}) AS ps
  FROM a
), t AS (
  SELECT page_id, CASE WHEN len(list_filter(regexp_split_to_array(whole, '\s+'), lambda x: x <> '')) >= 50 THEN whole
         ELSE array_to_string(list_concat([{_strip("array_to_string(ps, '')")}], list_transform(ps[2:], lambda x: {_strip('x')})), ' ') END AS text
  FROM p
)
SELECT page_id, ({_CAP}) AS body FROM (SELECT *, {_SPLIT} AS w FROM t)"""
_CARDS = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages),
x AS (SELECT page_id, i, 'https://example.com' || h[i] AS url, {_strip(_plain('t[i]'))} AS title FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM l)),
k AS (SELECT page_id, url, arg_min(title, i) AS title, min(i) AS i FROM x WHERE length(title) >= 10 GROUP BY page_id, url)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS ord, title, url, NULL::VARCHAR AS day FROM k"""

ORACLES: dict[str, str] = {
    "accuracy_summary": f"WITH {_VERDICTS} SELECT count(*) AS total, count(*) FILTER (verdict <> 'Pending') AS reviewed, count(*) FILTER (verdict = 'Pending') AS pending, count(*) FILTER (verdict = 'Confirmed') AS confirmed, count(*) FILTER (verdict IN ({_FP})) AS false_positives, round(coalesce(count(*) FILTER (verdict = 'Confirmed') / nullif(count(*) FILTER (verdict = 'Confirmed' OR verdict IN ({_FP})), 0), 0.0), 6)::DOUBLE AS precision FROM rows",
    "verdict_breakdown": f"WITH {_VERDICTS} SELECT verdict, count(*) AS n FROM rows GROUP BY verdict",
    "fp_by_reason": f"WITH {_VERDICTS}, {_FPS} SELECT verdict, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM fp), 4) AS percent FROM fp GROUP BY verdict",
    "fp_by_deal_type": f"WITH {_VERDICTS}, {_FPS} SELECT deal_type, count(*) AS n FROM fp WHERE deal_type <> '' GROUP BY deal_type",
    "fp_by_action": f"WITH {_VERDICTS}, {_FPS} SELECT action, count(*) AS n FROM fp WHERE action <> '' GROUP BY action",
    "fp_grouping_sets": f"WITH {_VERDICTS}, {_FPS}, u AS (SELECT 'deal_type' AS dimension, deal_type AS value FROM fp UNION ALL SELECT 'reason', verdict FROM fp UNION ALL SELECT 'action', action FROM fp) SELECT dimension, value, count(*) AS n FROM u WHERE value <> '' GROUP BY dimension, value",
    "fp_examples_top10": f"WITH {_VERDICTS}, {_FPS} SELECT doc_id, left(title, 80) AS title, verdict, deal_type, action, score FROM fp ORDER BY doc_id LIMIT 10",
    "lookback_window": "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published FROM events WHERE event_id % 10 = 0 OR ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR",
    "window_counters": "SELECT count(*) FILTER (event_id % 10 <> 0 AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 336 HOUR) AS kept_dated, count(*) FILTER (event_id % 10 = 0) AS kept_undated, count(*) FILTER (event_id % 10 <> 0 AND ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 336 HOUR) AS dropped FROM events",
    "url_distinct_keep_first": f"WITH {_EVENT_URLS} SELECT url, event_id, value FROM e QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts, event_id) = 1",
    "seen_anti_join": f"WITH {_EVENT_URLS} SELECT event_id, url FROM e WHERE url NOT IN (SELECT url FROM e WHERE ts < TIMESTAMP '2024-01-08')",
    "source_union_rank": f"WITH {_EVENT_URLS} SELECT CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS src_rank, count(*) AS n, count(DISTINCT url) AS urls FROM e WHERE event_type IN ('signup', 'view', 'click', 'purchase') GROUP BY event_type",
    "state_ttl_prune": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS first_seen FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND date_trunc('second', ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY",
    "seen_hash": "SELECT page_id, left(sha256(url), 16) AS hash FROM pages",
    "not_found_streak": f"WITH {_OUTCOMES} SELECT event_id, firm, streak FROM streaks",
    "flagged_firms": f"WITH {_OUTCOMES} SELECT firm FROM errors WHERE needs_url_update",
    "firm_error_state": f"WITH {_OUTCOMES} SELECT * FROM errors",
    "prefer_render_route": f"WITH {_OUTCOMES}, {_FIRMS} SELECT name, CASE WHEN coalesce(needs_url_update, false) THEN 'skip' WHEN press_url IS NULL THEN 'discover' WHEN coalesce(prefer_render, false) THEN 'render' ELSE 'plain' END AS route FROM firms LEFT JOIN errors ON name = 'Supplier#' || lpad(firm::VARCHAR, 9, '0')",
    "norm_text": f"SELECT doc_id, sha256({_norm('text')}) AS norm_sha FROM documents",
    "deal_key": f"""SELECT p_partkey, {_norm("' The ' || p_name || ' (Division)!'")} || '|' || {_norm('p_brand')} || '|' || lower(p_type) AS key FROM part""",
    "deal_tokens": f"SELECT doc_id, len(t)::BIGINT AS n, sha256(array_to_string(list_sort(t), ' ')) AS sha FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)",
    "acronym": f"""SELECT p_partkey, {_acronym("p_type || ' ' || p_name || ' of a Unit'")} AS acronym FROM part""",
    "token_jaccard_pairs": f"WITH {_DEALS}, d AS (SELECT DISTINCT seller, target FROM deals), k AS MATERIALIZED (SELECT *, {_tokens('target')} AS t FROM d) SELECT a.seller, a.target AS t1, b.target AS t2, round(len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))), 6) AS j FROM k a JOIN k b ON a.seller = b.seller AND a.target < b.target WHERE len(list_intersect(a.t, b.t)) > 0 AND 2 * len(list_intersect(a.t, b.t)) >= len(list_distinct(list_concat(a.t, b.t)))",
    "greedy_deal_dedup": f"WITH RECURSIVE {_DEALS}, fold_in AS (SELECT seller || '|' || stage AS block, ord, p_name AS title, target, seller, p_size AS conf, '' AS reasoning FROM deals JOIN part ON p_partkey = ord), {_FOLD} SELECT r.ord AS ord, split_part(block, '|', 2) AS stage, r.seller AS seller, r.target AS target, r.conf AS confidence, r.reasoning AS reasoning FROM folded",
    "mini_scan": f"WITH RECURSIVE {_ALERTS}, fold_in AS (SELECT coalesce(stage, '') AS block, ord, title, target_company AS target, seller, confidence AS conf, reasoning FROM scored WHERE ord % 9 <> 0 AND deal_type IS NOT NULL AND confidence >= 50 AND {_SOLD}), {_FOLD} SELECT stage, recommended_action, count(*) AS n, max(fit) AS best FROM folded JOIN scored ON scored.ord = folded.r.ord GROUP BY stage, recommended_action",
    "targets_match_pairs": f"WITH {_DEALS}, {_SIDES}, pairs AS (SELECT x.seller, x.stage, x.target, x.n AS n1, y.n AS n2, x.t AS t1, y.t AS t2, x.a AS a1, y.a AS a2, x.ns, x.ts FROM side x JOIN side y ON x.seller = y.seller AND x.stage = y.stage AND x.target <> y.target), rules AS {_RULES} SELECT seller, stage, target, count(*) AS n FROM rules WHERE {_MATCH} GROUP BY seller, stage, target",
    "fuzzy_deal_anti_join": f"WITH {_DEALS}, {_SIDES}, old AS (SELECT DISTINCT seller, stage, target FROM deals WHERE ord % 5 = 0), new AS (SELECT DISTINCT seller, stage, target FROM deals WHERE ord % 5 <> 0), pairs AS (SELECT x.seller, x.stage, x.target, x.n AS n1, y.n AS n2, x.t AS t1, y.t AS t2, x.a AS a1, y.a AS a2, x.ns, x.ts FROM side x SEMI JOIN new USING (seller, stage, target) JOIN (SELECT * FROM side SEMI JOIN old USING (seller, stage, target)) y ON x.seller = y.seller AND x.stage = y.stage), rules AS {_RULES}, hit AS (SELECT DISTINCT seller, stage, target FROM rules WHERE {_MATCH}) SELECT ord, target, stage FROM deals ANTI JOIN hit USING (seller, stage, target) WHERE ord % 5 <> 0",
    "cap_text": f"SELECT doc_id, length(c)::BIGINT AS n, sha256(c) AS sha FROM (SELECT doc_id, ({_CAP}) AS c FROM (SELECT doc_id, text, {_SPLIT} AS w FROM documents))",
    "word_gate": f"SELECT doc_id, len({_SPLIT}) >= 50 AS passes FROM documents",
    "date_cascade": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN CASE WHEN o_orderkey % 6 = 3 THEN '20' || strftime(o_orderdate, '%y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS day FROM orders",
    "url_date": "SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 2000 AND 2100 THEN CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01') END END AS day FROM orders",
    "host_filter": r"SELECT page_id, url FROM pages WHERE regexp_extract(url, '://([^/?#]*)', 1) = '' OR contains(regexp_extract(url, '://([^/?#]*)', 1), 'example.com')",
    "body_extract": _BODIES,
    "card_extract": _CARDS,
    "rss_parse": "SELECT user_id::VARCHAR AS firm_name, 'Event ' || event_id || ' & more' AS title, 'https://x.example.com/' || event_id AS url, event_type AS summary, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published FROM events",
    "feed_link_discovery": f"WITH {_LINKED} SELECT page_id, '/feed/' || page_id || '.xml' AS feed FROM linked WHERE page_id % 2 = 0",
    "press_candidate": rf"""WITH {_LINKED}, h AS (SELECT page_id, unnest(regexp_extract_all(body, '(?i)<a\s[^>]*?href=["'']([^"'']*)["'']', 1)) AS href FROM linked) SELECT page_id FROM h WHERE regexp_matches(lower(href), '/news/|/press/|/media/|/insight|release|announce|article') GROUP BY page_id HAVING count(*) >= 3""",
    "llm_batches": f"WITH {_BATCHED} SELECT i // 20 AS batch, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id, max(i % 20)::INT AS last_pos FROM numbered GROUP BY i // 20",
    "prompt_render": f"""WITH {_BATCHED} SELECT i // 20 AS batch, count(*)::INT AS n, sha256('Classify these items:' || chr(10) || string_agg((i % 20 + 1) || '. "' || source || '"' || CASE WHEN text <> '' THEN chr(10) || '   ' || text[1:1000] ELSE '' END, chr(10) ORDER BY i)) AS sha FROM numbered GROUP BY i // 20""",
    "llm_result_parse": f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 NOT IN (2, 3) AND t IN {DEAL_TYPES} THEN t END AS deal_type, CASE WHEN o_orderkey % 5 NOT IN (2, 3) AND o_orderkey % 3 = 0 THEN 'signing' END AS stage, (CASE WHEN o_orderkey % 5 IN (2, 3) THEN 0 ELSE o_orderkey % 101 END)::INT AS confidence, CASE WHEN o_orderkey % 5 IN (2, 3) THEN '' ELSE 'S' || o_custkey END AS seller FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'corporate_carveout' WHEN 2 THEN 'portco_carveout' ELSE 'merger' END AS t FROM orders)",
    "alert_filter": f"WITH {_ALERTS} SELECT ord, deal_type, seller, confidence FROM alerts WHERE deal_type IS NOT NULL AND confidence >= 50 AND {_SOLD}",
    "fit_score_caps": f"WITH {_ALERTS} SELECT ord, fit, recommended_action AS action FROM scored",
    "action_counts": f"WITH {_ALERTS} SELECT count(*) FILTER (recommended_action = 'pursue') AS pursue, count(*) FILTER (recommended_action = 'monitor') AS monitor, count(*) FILTER (recommended_action = 'discard') AS discard FROM scored",
    "sink_projection": f"WITH {_ALERTS} SELECT ord, trim(title) AS alert, '' AS pe_firm, target_company AS target, seller, fit AS score, url, reasoning, 'Pending' AS verdict, CASE WHEN is_carveout THEN deal_type END AS deal_type, nullif(buyer, '') AS buyer, upper(stage[1]) || stage[2:] AS stage, strftime(published, '%Y-%m-%d') AS date, recommended_action AS action, CASE WHEN recommended_action = 'pursue' AND stage IS NOT NULL THEN 'Queued' END AS brief_status FROM scored WHERE recommended_action IN ('pursue', 'monitor')",
    "csv_export": f"WITH {_ALERTS} SELECT coalesce(strftime(published, '%Y-%m-%d %H:%M'), '') AS date, firm_name AS firm, title, url, coalesce(deal_type, 'none') AS deal_type, coalesce(stage, '') AS stage, target_company, seller, buyer, confidence, reasoning FROM alerts",
    "cost_report": "SELECT sum(n_chars // 4)::BIGINT AS tokens_in, sum(n_chars // 40)::BIGINT AS tokens_out, round((sum(n_chars // 4) * 15 + sum(n_chars // 40) * 75) / 1000000.0::DOUBLE, 6) AS cost FROM documents",
    "backtest_by_type": f"WITH {_ALERTS} SELECT deal_type, count(*) AS n, min(ord) AS first_ord, round(avg(confidence), 6) AS mean_confidence FROM alerts WHERE deal_type IS NOT NULL GROUP BY deal_type",
    "targets_fill_nulls": f"WITH {_FIRMS} SELECT name, coalesce(press_url, CASE WHEN s_suppkey % 2 = 0 THEN 'https://found/' || s_suppkey END) AS press_url FROM firms",
    "discovery_counts": f"WITH {_FIRMS} SELECT count(*) FILTER (feed_url IS NOT NULL) AS with_feed, count(*) FILTER (feed_url IS NULL AND s_suppkey % 5 = 0) AS found, count(*) FILTER (feed_url IS NULL AND s_suppkey % 5 <> 0 AND press_url IS NOT NULL) AS press_only, count(*) FILTER (feed_url IS NULL AND s_suppkey % 5 <> 0 AND press_url IS NULL) AS none FROM firms",
    "first_valid_candidate": f"WITH {_FIRMS}, c AS (SELECT name, i - 1 AS priority, 'https://' || domain || p[i] AS url FROM (SELECT *, [{', '.join(repr(p) for p in PRESS_PATHS)}] AS p, unnest(range(1, {len(PRESS_PATHS) + 1})) AS i FROM firms)) SELECT name, arg_min(url, priority) AS url FROM c WHERE (length(name) + priority * 7 + length(url)) % 5 = 0 GROUP BY name",
    "scale_workers": "SELECT n_regionkey, (CASE WHEN n <= 0 THEN 10 ELSE least(32, greatest(10, ceil(n / 10))) END)::INT AS workers FROM (SELECT n_regionkey, count(*) * n_regionkey * 20 AS n FROM nation GROUP BY n_regionkey)",
}
