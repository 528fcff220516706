"""DuckDB twins of the registered queries (the correctness oracle).

Each query is plain SQL over the test tables.  The shared CTEs below repeat
the fixture derivations of ``crawlweave.plans.fixtures`` rule by rule.
"""

from __future__ import annotations

URLS_FX = """
urls_fx AS (
  SELECT 'CC-MAIN-2024-1' || CAST(page_id % 3 AS VARCHAR) AS snapshot_name,
         'CC-MAIN-2024-1' || CAST(page_id % 3 AS VARCHAR) || '/tt_meta_' || CAST(page_id % 2 AS VARCHAR)
           || '.jsonl.zst' AS hf_path,
         CASE WHEN page_id % 5 = 0 THEN upper(url) ELSE url END AS url_raw,
         regexp_replace(url, '#.*$', '') AS url_norm,
         CAST(CASE WHEN page_id % 11 = 0 THEN NULL
                   WHEN page_id % 23 = 0 THEN 0
                   ELSE 1704067200 + (page_id * 7919) % 2592000 END AS BIGINT) AS warc_date,
         '<urn:uuid:page-' || CAST(page_id AS VARCHAR) || '>' AS warc_record_id,
         'sha1:' || md5(url) AS digest,
         page_id AS ord
  FROM pages
)"""

STATE_FX = URLS_FX + """,
state_fx AS (
  SELECT snapshot_name, hf_path, url_raw, url_norm, warc_date, warc_record_id, digest,
         CAST(CASE WHEN ord % 4 IN (0, 1, 3) THEN ord * 1000 END AS BIGINT) AS "offset",
         CAST(CASE WHEN ord % 4 IN (0, 3) THEN CASE WHEN ord % 40 = 4 THEN 0 ELSE 500 + ord % 100 END END
              AS BIGINT) AS length,
         CASE WHEN ord % 4 IN (0, 3) THEN
              CASE WHEN ord % 8 = 0 THEN '/' ELSE '' END || 'crawl/seg-' || CAST(ord % 7 AS VARCHAR) || '.warc.gz'
         END AS filename,
         CASE WHEN ord % 4 = 0 AND ord % 7 = 2 THEN 'error'
              WHEN ord % 4 = 0 THEN 'matched'
              WHEN ord % 4 = 1 THEN 'missing'
              WHEN ord % 4 = 2 THEN 'pending'
              ELSE 'downloaded' END AS status,
         CASE WHEN ord % 4 = 3 THEN 'html/' || snapshot_name || '/' || CAST(ord AS VARCHAR) || '.html' END AS saved_path,
         CASE WHEN ord % 4 = 0 AND ord % 7 = 2 THEN 'boom ' || CAST(ord AS VARCHAR) END AS last_error,
         ord
  FROM urls_fx
)"""

CAPS = """
caps_raw AS (
  SELECT e.event_id, e.user_id, e.event_type, p.page_id,
         CASE WHEN e.user_id % 4 = 1 THEN upper(p.url)
              WHEN e.user_id % 4 = 2 THEN regexp_replace(p.url, '#.*$', '')
              ELSE p.url END AS cap_url,
         CASE WHEN e.user_id % 13 = 7 THEN ''
              WHEN e.user_id % 29 = 11 THEN 'x2024'
              ELSE strftime(e.ts, '%Y%m%d%H%M%S') END AS stamp,
         'CC-MAIN-2024-1' || CAST((CASE WHEN e.user_id % 11 = 4 THEN p.page_id + 1 ELSE p.page_id END) % 3
           AS VARCHAR) AS snapshot_name,
         lpad(CAST(e.event_id % 4 + 4 * (e.event_id // 100000) AS VARCHAR), 5, '0') AS shard
  FROM events e JOIN pages p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id
),
caps AS (
  SELECT snapshot_name, cap_url AS url,
         'crawl/seg-' || CAST(event_id % 7 AS VARCHAR) || '.warc.gz' AS filename,
         CAST(event_id * 1000 AS BIGINT) AS "offset",
         CAST(500 + event_id % 100 AS BIGINT) AS length,
         coalesce(CAST(epoch(try_strptime(stamp, '%Y%m%d%H%M%S')) AS BIGINT), 0) AS capture_ts,
         shard, event_id
  FROM caps_raw
  WHERE user_id % 31 <> 0 AND user_id % 37 <> 1      -- lines without a JSON record
    AND user_id % 41 <> 2 AND user_id % 43 <> 3      -- text behind the object, single quotes
    AND event_type <> 'error'                        -- image/png captures
    AND user_id % 17 <> 5                            -- offset is not an integer
)"""

CANDS = """
cand0 AS (
  SELECT ord, url_raw AS cand, 0 AS pos FROM rows_in WHERE coalesce(url_raw, '') <> ''
  UNION ALL SELECT ord, lower(url_raw), 1 FROM rows_in WHERE coalesce(url_raw, '') <> ''
  UNION ALL SELECT ord, url_norm, 2 FROM rows_in WHERE coalesce(url_norm, '') <> ''
),
cands AS (SELECT ord, cand, min(pos) AS pos FROM cand0 GROUP BY ord, cand),
pairs AS (
  SELECT r.ord, c.pos, k.filename, k."offset", k.length, k.capture_ts, k.shard, k.event_id,
         CASE WHEN r.warc_date IS NULL OR r.warc_date = 0 THEN 0
              WHEN k.capture_ts = 0 THEN 1000000000000
              ELSE abs(k.capture_ts - r.warc_date) END AS delta
  FROM rows_in r JOIN cands c ON c.ord = r.ord
  JOIN caps k ON k.snapshot_name = r.snapshot_name AND k.url = c.cand
)"""


def safe_name_sql(u: str, d: str) -> str:
    """DuckDB twin of ``scalars.safe_filename``."""
    c = (f"substring(regexp_replace(regexp_replace(coalesce({u}, ''), '[^\\p{{L}}\\p{{N}}._-]', '_', 'g'), "
         f"'^_+|_+$', '', 'g'), 1, 150)")
    named = f"(CASE WHEN coalesce({d}, '') <> '' THEN {c} || '_' || {d} ELSE {c} END)"
    return f"(CASE WHEN {named} = '' THEN 'unknown' ELSE {named} END)"


def _resolve_sql(order_by: str, rows_in: str, with_prefix: str = URLS_FX) -> str:
    return f"""
WITH {with_prefix}, {CAPS},
rows_in AS ({rows_in}),
{CANDS},
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ord ORDER BY {order_by}) AS rn FROM pairs
  ) WHERE rn = 1
)
SELECT r.snapshot_name, r.url_raw, r.warc_date,
       CASE WHEN b.ord IS NULL THEN 'missing' ELSE 'matched' END AS status,
       CASE WHEN b.ord IS NULL THEN r.filename ELSE b.filename END AS filename,
       CASE WHEN b.ord IS NULL THEN r."offset" ELSE b."offset" END AS "offset",
       CASE WHEN b.ord IS NULL THEN r.length ELSE b.length END AS length,
       b.capture_ts AS capture_ts
FROM rows_in r LEFT JOIN best b ON b.ord = r.ord
"""


ALL_URLS = ("SELECT *, CAST(NULL AS VARCHAR) AS filename, CAST(NULL AS BIGINT) AS \"offset\", "
            "CAST(NULL AS BIGINT) AS length FROM urls_fx")

UNRESOLVED_LIMITED = """
  SELECT * FROM state_fx
  WHERE "offset" IS NULL OR length IS NULL OR filename IS NULL
  ORDER BY snapshot_name, ord
  LIMIT 100"""

ORACLE: dict[str, str] = {
    "scan_captures": f"""
WITH {CAPS}
SELECT snapshot_name, url, filename, "offset", length, capture_ts FROM caps
""",
    "resolve_nearest": _resolve_sql("delta, shard, event_id", ALL_URLS),
    "resolve_priority": _resolve_sql("pos, delta, shard, event_id", ALL_URLS),
    "resolve_limited": _resolve_sql("delta, shard, event_id", UNRESOLVED_LIMITED, STATE_FX),
}

ORACLE["captures_pruned"] = f"""
WITH {STATE_FX}, {CAPS},
rows_in AS ({UNRESOLVED_LIMITED}),
wanted AS (
  SELECT snapshot_name, url_raw AS url FROM rows_in UNION SELECT snapshot_name, lower(url_raw) FROM rows_in
  UNION SELECT snapshot_name, url_norm FROM rows_in
)
SELECT k.snapshot_name, k.url, k.filename, k."offset", k.length, k.capture_ts
FROM caps k JOIN wanted w ON w.snapshot_name = k.snapshot_name AND w.url = k.url
"""

EVENTS_FX = """
ev AS (
  SELECT e.event_id % (SELECT count(*) FROM pages) AS ord, e.event_id AS seq,
         CASE e.event_type WHEN 'click' THEN 'matched' WHEN 'view' THEN 'missing'
              WHEN 'purchase' THEN 'downloaded' ELSE 'error' END AS kind,
         'crawl/seg-' || CAST(e.event_id % 7 AS VARCHAR) || '.warc.gz' AS filename,
         CAST(e.event_id * 1000 AS BIGINT) AS "offset",
         CAST(500 + e.event_id % 100 AS BIGINT) AS length,
         'html/' || CAST(e.event_id % (SELECT count(*) FROM pages) AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR)
           || '.html' AS saved_path,
         'failed ' || CAST(e.event_id AS VARCHAR) || ' ' || repeat('x', CAST(490 + e.user_id % 30 AS INTEGER)) AS message
  FROM events e WHERE e.event_type <> 'signup'
)"""

ORACLE.update({
    "resolve_summary": f"""
SELECT snapshot_name,
       CAST(count(*) FILTER (WHERE status = 'matched') AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE status = 'missing') AS BIGINT) AS missing
FROM ({_resolve_sql("delta, shard, event_id", ALL_URLS)}) r
GROUP BY ROLLUP (snapshot_name)
""",
    "state_latest": f"""
WITH {URLS_FX}, {EVENTS_FX},
f AS (
  SELECT ord,
         arg_max({{'f': filename, 'o': "offset", 'l': length}}, seq) FILTER (WHERE kind = 'matched') AS loc,
         arg_max(kind, seq) AS st,
         arg_max(saved_path, seq) FILTER (WHERE kind = 'downloaded') AS sp,
         arg_max({{'m': CASE WHEN kind = 'error' THEN substring(message, 1, 500) END}}, seq)
           FILTER (WHERE kind IN ('error', 'downloaded')) AS le
  FROM ev GROUP BY ord
)
SELECT u.snapshot_name, u.url_raw, coalesce(f.st, 'pending') AS status,
       f.loc.f AS filename, f.loc.o AS "offset", f.loc.l AS length,
       f.sp AS saved_path, f.le.m AS last_error
FROM urls_fx u LEFT JOIN f ON f.ord = u.ord
""",
    "pending_ranges": f"""
WITH {STATE_FX}
SELECT snapshot_name, url_raw, regexp_replace(filename, '^/+', '') AS archive, "offset", length,
       "offset" + length - 1 AS range_end, (length > 0 AND "offset" >= 0) AS range_valid,
       regexp_extract(filename, '([^/]*)/*$', 1) || '-' || CAST("offset" AS VARCHAR) || '-'
         || CAST("offset" + length - 1 AS VARCHAR) || '.warc.gz' AS part_name
FROM state_fx
WHERE filename IS NOT NULL AND "offset" IS NOT NULL AND length IS NOT NULL AND saved_path IS NULL
""",
    "archive_paths": f"""
WITH {STATE_FX}
SELECT DISTINCT filename FROM state_fx
WHERE filename IS NOT NULL AND "offset" IS NOT NULL AND length IS NOT NULL AND saved_path IS NULL
""",
    "progress_stats": f"""
WITH {STATE_FX}
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE filename IS NOT NULL) AS BIGINT) AS resolved,
       CAST(count(*) FILTER (WHERE saved_path IS NOT NULL) AS BIGINT) AS downloaded,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors
FROM state_fx
""",
    "safe_names": rf"""
WITH {URLS_FX},
named AS (
  SELECT 'p' || CAST(ord AS VARCHAR) AS item, url_raw AS u,
         CASE WHEN ord % 6 = 1 THEN NULL ELSE digest END AS d,
         regexp_replace(snapshot_name, '^CC-MAIN-', '') AS base
  FROM urls_fx
  UNION ALL
  SELECT 'd' || CAST(doc_id AS VARCHAR), 'https://example.org/' || text, NULL,
         regexp_replace(source, '^CC-MAIN-', '')
  FROM documents
),
cleaned AS (
  SELECT item, d, base,
         substring(regexp_replace(regexp_replace(coalesce(u, ''), '[^\p{{L}}\p{{N}}._-]', '_', 'g'),
                                  '^_+|_+$', '', 'g'), 1, 150) AS c
  FROM named
)
SELECT item,
       CASE WHEN (CASE WHEN coalesce(d, '') <> '' THEN c || '_' || d ELSE c END) = '' THEN 'unknown'
            ELSE (CASE WHEN coalesce(d, '') <> '' THEN c || '_' || d ELSE c END) END || '.html' AS name,
       base
FROM cleaned
""",
})

META = """
mp AS (
  SELECT page_id AS pid, url,
         CASE page_id % 3 WHEN 0 THEN 'CC-MAIN-2024-10' WHEN 1 THEN '2024-11' ELSE 'CC-MAIN-2024-12' END AS d,
         (page_id // 3) % 2 AS half, (page_id // 3000) * 2 AS blk
  FROM pages
),
meta_recs AS (
  SELECT 'meta/tt/' || d || '/tt_meta_' || lpad(CAST(half + blk AS VARCHAR), 4, '0') || '.jsonl.zst' AS hf_path,
         pid * 10 AS seq, CASE WHEN pid % 13 = 5 THEN '' ELSE url END AS u, pid, 0 AS copy, url
  FROM mp
  UNION ALL
  SELECT 'meta/tt/' || d || '/tt_meta_' || lpad(CAST(half + blk AS VARCHAR), 4, '0') || '.jsonl.zst',
         pid * 10 + 1, url, pid, 1, url
  FROM mp WHERE pid % 10 = 0 AND pid % 17 <> 0
  UNION ALL
  SELECT 'meta/tt/' || d || '/tt_meta_' || lpad(CAST(1 - half + blk AS VARCHAR), 4, '0') || '.jsonl.zst',
         pid * 10 + 4, url, pid, 2, url
  FROM mp WHERE pid % 25 = 0
),
meta_valid AS (
  SELECT hf_path, seq, u AS url_raw,
         'CC-MAIN-' || regexp_replace(split_part(hf_path, '/', 3), '^CC-MAIN-', '') AS snapshot_name,
         CAST(CASE WHEN pid % 9 = 7 THEN NULL ELSE 1704067200 + (pid * 7919) % 2592000 + 60 * copy END AS BIGINT)
           AS warc_date,
         '<urn:uuid:' || CAST(pid AS VARCHAR) || '-' || CAST(copy AS VARCHAR) || '>' AS warc_record_id,
         CASE WHEN pid % 4 IN (1, 2) THEN 'sha1:P' ELSE 'sha1:B' END || md5(url) AS digest
  FROM meta_recs WHERE u <> ''
),
meta_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY hf_path, url_raw ORDER BY seq) AS rn FROM meta_valid
  ) WHERE rn = 1
)"""

_INGESTED = f"""
WITH {META}
SELECT snapshot_name, hf_path, url_raw, url_raw AS url_norm, warc_date, warc_record_id, digest
FROM meta_first
"""

ORACLE.update({
    "ingest_metadata": _INGESTED,
    "ingest_incremental": _INGESTED,
    "ingest_counts": f"""
WITH {META}
SELECT v.hf_path, CAST(count(*) AS BIGINT) AS parsed,
       CAST(count(DISTINCT v.url_raw) AS BIGINT) AS inserted
FROM meta_valid v GROUP BY v.hf_path
""",
})



_NL = "chr(10)"


def _page_entities(e: str) -> str:
    """The four entities of the test pages decoded."""
    for code, char in (("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"'), ("&amp;", "&")):
        e = f"replace({e}, '{code}', '{char}')"
    return e


def _page_lines(e: str) -> str:
    """Lines of single-spaced words, at most one empty line between two."""
    kept = (f"array_to_string(list_transform(string_split({e}, {_NL}), "
            f"lambda x: array_to_string(list_filter(string_split(translate(x, chr(9) || chr(13), '  '), ' '), "
            f"lambda w: w <> ''), ' ')), {_NL})")
    return f"trim(regexp_replace({kept}, '\\n{{3,}}', {_NL} || {_NL}, 'g'), {_NL} || ' ')"


def page_markdown_sql(table: str, id_col: str, html_col: str) -> str:
    """Expected markdown of the test pages, from what is known of their make-up: one article of h1, p, br and
    unclosed b, four entities, a title.  Plain splits and replaces; no rule of the engine is used."""
    nl, entities, lines = _NL, _page_entities, _page_lines
    article = f"split_part(split_part({html_col}, '<article>', 2), '</article>', 1)"
    for tag, text in (("<h1>", f"{nl} || {nl} || '# '"), ("</h1>", f"{nl} || {nl}"), ("<p>", f"{nl} || {nl}"),
                      ("</p>", f"{nl} || {nl}"), ("<br>", nl), ("<b>", "''")):
        article = f"replace({article}, '{tag}', {text})"
    title = f"split_part(split_part({html_col}, '<title>', 2), '</title>', 1)"
    return f"""
WITH md AS (SELECT {id_col}, {html_col}, {lines(entities(article))} AS body, {lines(entities(title))} AS title FROM {table})
SELECT {id_col},
       CASE WHEN {html_col} IS NOT NULL AND body <> '' THEN
         CASE WHEN title <> '' THEN '---' || chr(10) || 'title: ' || title || chr(10) || '---' || chr(10) || chr(10)
              ELSE '' END || body END AS markdown
FROM md
"""


ORACLE["resolve_complete_index"] = f"""
SELECT * FROM ({ORACLE["resolve_nearest"]}) r WHERE snapshot_name = 'CC-MAIN-2024-10'
UNION ALL
SELECT snapshot_name, url_raw, warc_date, 'pending', NULL, NULL, NULL, NULL
FROM (WITH {URLS_FX} SELECT * FROM urls_fx) u WHERE snapshot_name <> 'CC-MAIN-2024-10'
"""

ORACLE["ingest_shards"] = f"""
WITH {META}
SELECT r.hf_path,
       'CC-MAIN-' || regexp_replace(split_part(r.hf_path, '/', 3), '^CC-MAIN-', '') AS snapshot_name,
       true AS imported, CAST(count(v.seq) AS BIGINT) AS total_urls
FROM meta_recs r LEFT JOIN meta_valid v ON v.hf_path = r.hf_path AND v.seq = r.seq
GROUP BY r.hf_path
UNION ALL
SELECT 'meta/tt/CC-MAIN-2024-10/tt_meta_' || n || '.jsonl.zst', 'CC-MAIN-2024-10', true, 0
FROM (VALUES ('junk'), ('none')) t(n)
"""

_RUNS = """
r AS (
  SELECT ev.*, CASE WHEN (SELECT max(event_id) FROM events) - seq < 40 THEN 2
                    WHEN (SELECT max(event_id) FROM events) - seq < 240 THEN 1 ELSE 0 END AS run
  FROM ev
)"""

ORACLE["progress_deltas"] = f"""
WITH {EVENTS_FX}, {_RUNS},
upto AS (SELECT CAST(n AS INTEGER) AS after_run FROM range(-1, 3) AS t(n)),
last AS (
  SELECT upto.after_run, p.page_id, count(*) FILTER (WHERE r.kind = 'matched') > 0 AS resolved,
         count(*) FILTER (WHERE r.kind = 'downloaded') > 0 AS downloaded, arg_max(r.kind, r.seq) AS kind
  FROM upto CROSS JOIN pages p LEFT JOIN r ON r.ord = p.page_id AND r.run <= upto.after_run
  GROUP BY ALL
)
SELECT after_run, count(*) AS total, CAST(count(*) FILTER (WHERE resolved) AS BIGINT) AS resolved,
       CAST(count(*) FILTER (WHERE downloaded) AS BIGINT) AS downloaded,
       CAST(count(*) FILTER (WHERE kind = 'error') AS BIGINT) AS errors
FROM last GROUP BY after_run
"""

ORACLE["state_buckets"] = f"""
WITH {EVENTS_FX}, {_RUNS}
SELECT CAST(run AS INTEGER) AS run, count(*) AS events, true AS only_touched, CAST(0 AS BIGINT) AS differing
FROM r GROUP BY run
"""

ORACLE["ingest_framed"] = ORACLE["ingest_metadata"]  # the same records, however the shards are cut into frames

ORACLE["ready_counts"] = f"""
WITH {STATE_FX}, snaps AS (SELECT 'CC-MAIN-2024-1' || n AS snapshot_name FROM range(3) AS t(n)),
ready AS (
  SELECT snapshot_name FROM state_fx
  WHERE filename IS NOT NULL AND "offset" IS NOT NULL AND length IS NOT NULL AND saved_path IS NULL
)
SELECT s.snapshot_name, count(r.snapshot_name) AS ready FROM snaps s LEFT JOIN ready r USING (snapshot_name) GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM ready
"""

# the pages' addresses are in normal form but for their fragment; what each spelling adds is known
ORACLE["url_normal_forms"] = """
WITH p AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host,
         split_part(regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1), '#', 1) AS rest
  FROM pages
)
SELECT page_id, scheme || '://' || CASE WHEN page_id % 10 = 7 THEN 'xn--bcher-kva.' ELSE '' END || host
       || CASE page_id % 10 WHEN 4 THEN '/~A' WHEN 5 THEN '/%C3%A9%2F' WHEN 6 THEN '/a%20%C3%A9%3C' WHEN 8 THEN '/50%25'
                            WHEN 9 THEN '/l' ELSE '' END || rest AS url
FROM p
"""

# a key is (shard, URL): the first row of a batch counts, later batches do not repeat it
ORACLE["ingest_overlap"] = """
WITH p AS (SELECT page_id % 2 AS shard, url, min(page_id) AS page_id FROM pages GROUP BY ALL),
again AS (
  SELECT DISTINCT page_id % 2 AS shard, url FROM pages
  WHERE page_id // 20 = 1 OR (page_id >= 80 AND page_id % 2 = 1)
)
SELECT least(p.page_id // 20, 4) AS batch, count(*) AS rows, count(a.url) AS colliding, count(a.url) > 0 AS read
FROM p LEFT JOIN again a ON a.shard = p.shard AND a.url = p.url
GROUP BY 1
"""

ORACLE["html_markdown"] = page_markdown_sql("pages", "page_id", "html")

ORACLE["markdown_cases"] = """
SELECT page_id, replace(replace(CASE page_id % 12
  WHEN 0 THEN 'hello {k}'
  WHEN 1 THEN 'one {k}||two'
  WHEN 2 THEN '{k} in body'
  WHEN 3 THEN '{k}'
  WHEN 4 THEN '{k} street'
  WHEN 5 THEN 'See [{k}](' || url || ') and **bold {k}** *it*'
  WHEN 6 THEN '#### {k}||x||###### y'
  WHEN 7 THEN '1. {k}$1. b||- c'
  WHEN 8 THEN '| {k} | v |$| 1 | 2 |'
  WHEN 9 THEN '{k}' || chr(8212) || chr(233) || 'A&nope;&lt;'
  WHEN 10 THEN '---$title: T {k}$author: A B$description: D$---||x'
  ELSE '```${k} = 1$```||use `{k}`' END, '||', '$$'), '$', chr(10)).replace('{k}', 'k' || page_id) AS markdown
FROM pages
"""

_LONG = "A sentence of the main text {k} that is long enough to stand for itself, beside what is no part of it."

ORACLE["block_cases"] = f"""
SELECT page_id, replace(replace(CASE page_id % 14
  WHEN 0 THEN '1 < {{k}} and 3 > 2 <3'
  WHEN 1 THEN '```$  def {{k}}():$      return  1$```'
  WHEN 2 THEN '**bold *{{k}}*** and open'
  WHEN 3 THEN '[{{k}}](' || url || ') [y](/x)'
  WHEN 4 THEN '- {{k}}$  - b$  - c$- d$  1. e'
  WHEN 5 THEN '| {{k}} | v |$|---|---|$| 1 | a\\|b |'
  WHEN 6 THEN '---$title: T {{k}}$---$$x'
  WHEN 7 THEN 'teaser {{k}}$${_LONG}'
  WHEN 8 THEN '{{k}}'
  WHEN 9 THEN 'menu {{k}}$$text behind an open menu'
  WHEN 10 THEN '{_LONG}'
  WHEN 11 THEN '## {{k}}$$layout$$beside'
  WHEN 12 THEN '> {{k}}$$> said$$x$$y'
  ELSE 'a {{k}}$$&#0;&copy' END, '$', chr(10)), '{{k}}', 'k' || page_id) AS markdown
FROM pages
"""

# What the test pages are made of, from front to end: a list of links, an advertisement, an article of a heading
# and paragraphs (with unclosed b and br), a footer.
ORACLE["page_blocks"] = f"""
WITH parts AS (
  SELECT page_id, 1 AS place, unnest(string_split(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<li>')[2:]) AS piece,
         unnest(range(len(string_split(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<li>')) - 1)) AS nth,
         'li' AS tag, 5 AS depth, false AS kept FROM pages
  UNION ALL
  SELECT page_id, 2, split_part(split_part(html, '<div class="ad">', 2), '</div>', 1), 0, 'div', 3, false FROM pages
  UNION ALL
  SELECT page_id, 3, unnest(string_split(split_part(split_part(html, '<article>', 2), '</article>', 1), '<p>')),
         unnest(range(len(string_split(split_part(split_part(html, '<article>', 2), '</article>', 1), '<p>')))),
         'p', 4, true FROM pages
  UNION ALL
  SELECT page_id, 4, split_part(split_part(html, '<footer>', 2), '</footer>', 1), 0, 'footer', 3, false FROM pages
),
told AS (
  SELECT page_id, place, nth, depth, kept, CASE WHEN contains(piece, '<h1>') THEN 'h1' ELSE tag END AS tag,
         tag = 'li' AS linked, CAST(len(string_split(piece, '<b>')) + len(string_split(piece, '<br>'))
                                    + len(string_split(piece, '<a ')) - 2 AS DOUBLE) AS tags,
         regexp_replace(regexp_replace(piece, '<br>', chr(10), 'g'), '<[^<>]*>', '', 'g') AS body
  FROM parts
),
sized AS (SELECT *, CAST(length({_page_lines(_page_entities("body"))}) AS BIGINT) AS text_chars FROM told)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place, nth) AS INTEGER) AS block, tag, depth,
       text_chars, CASE WHEN linked THEN text_chars ELSE 0 END AS link_chars, text_chars / tags AS text_density,
       CASE WHEN linked THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS link_density, kept
FROM sized WHERE text_chars > 0
"""

ORACLE["extract_records"] = f"""
WITH p AS (
  SELECT page_id AS pid, url, html, 'CC-MAIN-2024-1' || CAST(page_id % 3 AS VARCHAR) AS snapshot_name,
         'sha1:' || md5(url) AS digest,
         CASE WHEN page_id % 33 = 6 THEN 'record ends early'
              WHEN page_id % 9 = 4 THEN 'WARC target mismatch'
              WHEN page_id % 21 = 9 THEN 'content encoding br is not supported' END AS failure
  FROM pages
)
SELECT snapshot_name, url AS url_raw,
       CASE WHEN pid % 11 = 5 THEN 'matched' WHEN failure IS NOT NULL THEN 'error' ELSE 'downloaded' END AS status,
       CASE WHEN pid % 11 <> 5 AND failure IS NULL
            THEN 'html/' || snapshot_name || '/' || {safe_name_sql('url', 'digest')} || '.html' END AS saved_path,
       CASE WHEN pid % 11 <> 5 THEN failure END AS last_error,
       CASE WHEN pid % 11 = 5 OR failure IS NOT NULL THEN NULL
            WHEN pid % 10 = 3 THEN chr(65533) || html ELSE html END AS html
FROM p
"""

ORACLE["decode_payloads"] = """
SELECT page_id,
       CASE WHEN page_id % 33 = 6 OR page_id % 21 = 9 THEN NULL
            WHEN page_id % 10 = 3 THEN chr(65533) || html ELSE html END AS html,
       CASE WHEN page_id % 33 = 6 THEN 'record ends early'
            WHEN page_id % 21 = 9 THEN 'content encoding br is not supported' END AS error
FROM pages
"""

ORACLE["archive_members"] = """
WITH p AS (
  SELECT page_id, url, 'crawl/seg-' || (page_id % 4 + 4 * (page_id // 1000)) || '.warc.gz' AS archive,
         lag(page_id) OVER (PARTITION BY page_id % 4 + 4 * (page_id // 1000) ORDER BY page_id) AS before
  FROM pages
)
SELECT archive, url, CASE WHEN page_id % 19 = 4 THEN 'torn' WHEN page_id % 33 = 6 THEN 'short' ELSE 'whole' END AS state,
       true AS covered
FROM p
UNION ALL
SELECT archive, NULL, 'junk', true FROM p WHERE page_id % 23 = 6 AND (before IS NULL OR before % 19 <> 4)
"""

_SAVED_SRC = f"""
WITH {STATE_FX},
src AS (
  SELECT s.*, CASE WHEN s.ord % 12 = 7 THEN NULL ELSE p.html END AS html
  FROM state_fx s JOIN pages p ON p.page_id = s.ord
  WHERE s.saved_path IS NOT NULL
),
md AS ({page_markdown_sql("src", "ord", "html")})
SELECT regexp_replace(src.snapshot_name, '^CC-MAIN-', '') AS snapshot, lower(coalesce(src.url_raw, '')) AS url,
       src."offset", src.length, src.filename, src.html, md.markdown, src.ord
FROM src JOIN md ON md.ord = src.ord
"""

ORACLE["export_snapshot"] = f"""
SELECT snapshot, url, "offset", length, filename, html, markdown FROM ({_SAVED_SRC}) x
"""

ORACLE["export_limited"] = f"""
SELECT snapshot, url, "offset", length, filename, html, markdown FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot ORDER BY ord) AS rn FROM ({_SAVED_SRC}) x
) WHERE rn <= 20
"""

ORACLE["export_split_parts"] = f"""
WITH RECURSIVE src AS (
  SELECT page_id AS ord, html, regexp_replace('CC-MAIN-2024-1' || CAST(page_id % 3 AS VARCHAR), '^CC-MAIN-', '') AS snapshot
  FROM pages
),
md AS ({page_markdown_sql("src", "ord", "html")}),
r AS (
  SELECT src.snapshot, src.ord,
         CAST(coalesce(strlen(src.html), 0) + coalesce(strlen(md.markdown), 0) AS BIGINT) AS bytes
  FROM src JOIN md ON md.ord = src.ord
),
idx AS (SELECT *, (row_number() OVER (PARTITION BY snapshot ORDER BY ord) - 1) // 20 AS batch FROM r),
b AS (SELECT snapshot, batch, sum(bytes) AS bytes, count(*) AS n FROM idx GROUP BY snapshot, batch),
walk(snapshot, batch, part, acc) AS (
  SELECT snapshot, batch, 0, bytes FROM b WHERE batch = 0
  UNION ALL
  SELECT w.snapshot, b.batch,
         CASE WHEN w.acc >= 65536 THEN w.part + 1 ELSE w.part END,
         CASE WHEN w.acc >= 65536 THEN b.bytes ELSE w.acc + b.bytes END
  FROM walk w JOIN b ON b.snapshot = w.snapshot AND b.batch = w.batch + 1
)
SELECT w.snapshot, CAST(w.part AS INTEGER) AS part, CAST(sum(b.n) AS BIGINT) AS rows, CAST(sum(b.bytes) AS BIGINT) AS bytes
FROM walk w JOIN b ON b.snapshot = w.snapshot AND b.batch = w.batch
GROUP BY w.snapshot, w.part
"""

ORACLE["shard_manifest_missing"] = """
WITH lines AS (
  SELECT 'CC-MAIN-2024-1' || CAST(event_id % 3 AS VARCHAR) AS snapshot_name, event_id, event_type,
         CASE WHEN event_id % 97 = 0 THEN '   ' ELSE
           CASE WHEN event_id % 2 = 0 THEN 'commoncrawl/' ELSE '' END || 'crawl-data/CC-MAIN-2024-1'
           || CAST(event_id % 3 AS VARCHAR) || '/indexes/'
           || CASE WHEN event_type = 'error' THEN 'cdx-' || lpad(CAST(event_id % 1000 AS VARCHAR), 5, '0') || '.gz.tmp'
                   WHEN event_type = 'signup' THEN 'cluster.idx'
                   ELSE 'cdx-' || lpad(CAST(event_id % 1000 AS VARCHAR), 5, '0') || '.gz' END
         END AS line
  FROM events
),
entries AS (
  SELECT DISTINCT snapshot_name, rel_path, regexp_extract(rel_path, '[^/]*$') AS basename
  FROM (SELECT snapshot_name,
               CASE WHEN trim(line) LIKE '%commoncrawl/%' THEN regexp_extract(trim(line), '.*commoncrawl/(.*)$', 1)
                    ELSE trim(line) END AS rel_path
        FROM lines WHERE trim(line) <> '')
),
present AS (
  SELECT DISTINCT 'CC-MAIN-2024-1' || CAST(event_id % 3 AS VARCHAR) AS snapshot_name,
         'cdx-' || lpad(CAST(event_id % 1000 AS VARCHAR), 5, '0') || '.gz' AS basename
  FROM events WHERE event_type = 'view' AND (event_id % 1000) % 7 = 3
)
SELECT e.snapshot_name, e.rel_path, e.basename FROM entries e
WHERE regexp_full_match(e.basename, 'cdx-[0-9]{5}[.]gz')
  AND NOT EXISTS (SELECT 1 FROM present p WHERE p.snapshot_name = e.snapshot_name AND p.basename = e.basename)
"""

_READY = 'filename IS NOT NULL AND "offset" IS NOT NULL AND length IS NOT NULL AND saved_path IS NULL'

ORACLE.update({
    "progress_by_snapshot": f"""
WITH {STATE_FX}
SELECT snapshot_name,
       CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE filename IS NOT NULL) AS BIGINT) AS resolved,
       CAST(count(*) FILTER (WHERE saved_path IS NOT NULL) AS BIGINT) AS downloaded,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors
FROM state_fx GROUP BY ROLLUP (snapshot_name)
""",
    "export_counts": f"""
WITH {STATE_FX}
SELECT snapshot_name, CAST(least(count(*), 20) AS BIGINT) AS rows
FROM state_fx WHERE saved_path IS NOT NULL GROUP BY snapshot_name
""",
    "snapshot_lists": f"""
WITH {STATE_FX}
SELECT DISTINCT 'unresolved' AS kind, snapshot_name FROM state_fx
WHERE "offset" IS NULL OR length IS NULL OR filename IS NULL
UNION ALL
SELECT DISTINCT 'saved' AS kind, snapshot_name FROM state_fx WHERE saved_path IS NOT NULL
""",
    "ready_budget": f"""
WITH {STATE_FX}
SELECT snapshot_name, url_raw, filename, "offset", length FROM state_fx
WHERE {_READY} ORDER BY filename, "offset" LIMIT 25
""",
    "saved_budget": f"""
WITH {STATE_FX}
SELECT snapshot_name, url_raw, saved_path FROM state_fx
WHERE saved_path IS NOT NULL AND snapshot_name = 'CC-MAIN-2024-11' ORDER BY ord LIMIT 25
""",
    "archive_budget": """
WITH p AS (
  SELECT page_id AS pid, url,
         'crawl/seg-' || CAST(page_id % 4 + 4 * (page_id // 1000) AS VARCHAR) || '.warc.gz' AS archive
  FROM pages
),
present AS (SELECT DISTINCT archive FROM p WHERE pid % 11 <> 5),
first AS (SELECT archive FROM present ORDER BY archive LIMIT 3)
SELECT p.archive, p.url AS url_raw, true AS range_valid
FROM p JOIN first f ON f.archive = p.archive
WHERE p.pid % 11 <> 5
""",
})
