"""SQL for DuckDB of the queries over site pages, files and written texts."""

from __future__ import annotations

from inkloom.plans.inputs import ADDRESSES, FORMS
from inkloom.plans.oracles import DOC_LINES, FAILED, MERGED, NL, NONSPACE, PARSED, R1C, R1V, R2, R4, SEP, SQUEEZED, WS, heads, packed, strip

assert DOC_LINES and FAILED and NONSPACE  # the names that this module shares with the other


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def chars(*codes: int) -> str:
    return " || ".join(f"chr({c})" for c in codes)


def forms() -> str:
    made = ", ".join(f"replace(replace(replace({quoted(f).replace(chr(9), chr(39) + ' || chr(9) || ' + chr(39))}, '{{n}}', n), '{{t}}', t), '{{w}}', translate(n, '0123456789', '０１２３４５６７８９'))" for f in FORMS)
    c = "SELECT cat_id, coalesce(chapter_num, 1)::VARCHAR AS n, coalesce(title, '') AS t FROM chapter_catalog"
    return f"SELECT cat_id, unnest(range({len(FORMS)}))::INTEGER AS form, unnest([{made}]) AS line FROM ({c})"


# What the router is to answer for each of the addresses, in their order.
ROUTED = ("hjwzw", "tw", "zhswx", "dxmwx", "dxmwx", "czbooks", "piaotia", "quanben", "sto55", "shuba", "shuba", "shuba", "shuba", "shuba", None, None, None)
ALIASED = {"hjwzw": "hjwzw", "tw": "tw", "linovelib": "tw", "zhswx": "zhswx", "dxmwx": "dxmwx", "czbooks": "czbooks", "piaotia": "piaotia", "quanben": "quanben", "shuba": "shuba", "69shuba": "shuba", "sto55": "sto55"}

BLANKS = "'[ \\t\\n\\r\\f]+'"


def shown(x: str) -> str:
    """A text as a browser shows it."""
    return strip(f"regexp_replace({x}, {BLANKS}, ' ', 'g')")


ZW = "[\\x{200b}\\x{200c}\\x{200d}\\x{feff}]"


def closed(x: str) -> str:
    """Gaps of more than one blank line closed."""
    return f"regexp_replace({x}, '\\n[{WS}]*\\n[{WS}]*\\n+', {SEP}, 'g')"


def lines(raw: str, of: str, keep: str = "true") -> str:
    """The filled lines of a text, each as ``of`` says, in one."""
    return f"array_to_string(list_filter(list_transform(string_split({raw}, {NL}), lambda x: {of}), lambda x: x <> '' AND {keep}), {SEP})"


RAW = "coalesce(content, '')"
PS = lines(RAW, shown("x"))
TIDY = closed(f"regexp_replace({PS}, '{ZW}', '', 'g')")
SOFT = f"replace({RAW}, chr(160), ' ')"
NAV_WORDS = "NOT regexp_matches(x, '上一章|下一章|目录|www\\.piaotia\\.com|飘天文学')"


def once(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def esc(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(160), '&nbsp;')"



PIAOTIA = strip(closed(f"regexp_replace({once(lines(SOFT, strip('x'), NAV_WORDS))}, '[ \\t]+', ' ', 'g')"))
TITLE = shown("coalesce(title, '')")
ESC_LINES = f"string_split({esc(RAW)}, {NL})"
SHUBA_LINES = f"array_to_string(list_filter(list_transform(CASE WHEN {strip(f'{ESC_LINES}[1]')} = {TITLE} THEN {ESC_LINES}[2:] ELSE {ESC_LINES} END, lambda x: {strip('x')}), lambda x: x <> ''), {SEP})"
SHUBA = f"CASE WHEN {SHUBA_LINES} = '' THEN '' ELSE " + strip(f"regexp_replace({closed(f'''regexp_replace(chr(39) || {SHUBA_LINES}, '{ZW}', '', 'g')''')}, '　+', '　　', 'g')") + " END"
STO_WORDS = "NOT regexp_matches(x, '本章節來源於|STO55\\.COM|sto55\\.com|ADVERTISEMENT|𝕊𝕋𝕆𝟝𝟝|ℂ𝕆𝕄')"
STO_LINES = lines(SOFT, strip("x"), STO_WORDS)
STO55 = f"CASE WHEN {STO_LINES} = '' THEN '' ELSE " + strip(closed(f"regexp_replace(regexp_replace(chr(39) || {STO_LINES}, '{ZW}', '', 'g'), '[ \\t]+', ' ', 'g')")) + " END"
CZBOOKS = strip(f"regexp_replace({esc(RAW)} || {NL}, '\\n[{WS}]*\\n', {SEP}, 'g')")
QUANBEN = strip(f"regexp_replace(replace(regexp_replace({PS}, '[\\x{{200b}}\\x{{feff}}]', '', 'g'), chr(160), ' '), '\\n{{3,}}', {SEP}, 'g')")
NEXT = "coalesce(next_url, 'https://site.example/a/index.html')"
SITES = f"""SELECT page_id, parser, CASE WHEN parser = 'piaotia' AND {TITLE} = '' THEN '書名' WHEN parser = 'dxmwx' AND {TITLE} = '' THEN 'Không có tiêu đề' ELSE {TITLE} END AS title, CASE parser WHEN 'tw' THEN '卷一 Vol' ELSE '' END AS volume,
    CASE parser WHEN 'hjwzw' THEN {TIDY} WHEN 'quanben' THEN {QUANBEN} WHEN 'piaotia' THEN {PIAOTIA} WHEN 'shuba' THEN {SHUBA} WHEN 'sto55' THEN {STO55} WHEN 'czbooks' THEN {CZBOOKS} ELSE {strip(TIDY)} END AS content,
    CASE parser WHEN 'piaotia' THEN {NEXT} WHEN 'czbooks' THEN {NEXT} WHEN 'shuba' THEN next_url WHEN 'sto55' THEN CASE WHEN contains({NEXT}, '/book/') AND length({NEXT}) - length(replace({NEXT}, '/', '')) = 4 AND NOT ends_with({NEXT}, '.html') THEN NULL ELSE {NEXT} END END AS next_url,
    CASE parser WHEN 'shuba' THEN {SHUBA_LINES} <> '' WHEN 'sto55' THEN {STO_LINES} <> '' ELSE true END AS success
    FROM (SELECT *, ['hjwzw', 'tw', 'quanben', 'zhswx', 'dxmwx', 'piaotia', 'shuba', 'sto55', 'czbooks'][(page_id % 9)::INTEGER + 1] AS parser FROM crawl_pages)"""

CRAWLED = """SELECT DISTINCT ON (book) book AS series_name, chapter_num AS chapter_count, url AS last_url, title AS last_title FROM crawl_pages WHERE success ORDER BY book, fetched_at DESC NULLS LAST, page_id DESC"""
STYLED = "CASE WHEN lang = 'zh' THEN 'opacity:0.4' ELSE '' END"
FILLED = f"list_filter(list_transform(string_split(content, {NL}), lambda x: {strip('x')}), lambda x: x <> '')"


def xml(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x{{9}}\\x{{A}}\\x{{D}}\\x{{20}}-\\x{{D7FF}}\\x{{E000}}-\\x{{FFFD}}\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')"


MARK = "CASE WHEN coalesce(content, '') <> '' THEN chr(10) || content || chr(10) ELSE '' END"
SEGMENT_FILES = f"SELECT book || '/' || {R4} || '.yaml' AS path, (row_number() OVER (PARTITION BY book, {R4} ORDER BY ord, row_id) - 1)::BIGINT AS ord, id, title, content FROM segments WHERE {R4} IS NOT NULL"
CATALOG_FILES = "SELECT book || '/' || (cat_id // 100) || '.json' AS path, row_number() OVER (PARTITION BY book, cat_id // 100 ORDER BY cat_id)::INTEGER AS position, chapter_num AS index, title, url FROM chapter_catalog"

SQL: dict[str, str] = {
    "heading_forms": f"SELECT cat_id, form, nullif(kind, 'body') AS kind, number, title FROM ({heads(f'''SELECT cat_id, form, regexp_replace({strip('line')}, '^\\x{{feff}}', '') AS b FROM ({forms()})''')})",
    "route_real": f"SELECT page_id, replace(unnest([{', '.join(map(quoted, ADDRESSES))}]), '{{}}', page_id::VARCHAR) AS url, unnest([{', '.join(quoted(r) if r else 'NULL' for r in ROUTED)}]) AS parser FROM crawl_pages",
    "route_url": "SELECT page_id, NULL::VARCHAR AS parser, CASE WHEN contains(url, 'slowreader') THEN 'site_a' WHEN contains(url, 'canxue') THEN 'site_b' WHEN contains(url, '.example') THEN 'site_c' WHEN contains(url, '.invalid') THEN 'site_d' END AS site FROM crawl_pages",
    "parsers_by_name": f"""WITH a AS (SELECT unnest([{', '.join(map(quoted, ALIASED))}]) AS alias, unnest([{', '.join(map(quoted, ALIASED.values()))}]) AS parser), n AS (SELECT alias AS name FROM a UNION SELECT upper(alias) FROM a UNION SELECT CASE WHEN alias = '69shuba' THEN '69Shuba' ELSE upper(alias[1]) || alias[2:] END FROM a UNION SELECT source FROM documents UNION SELECT provider FROM translations)
        SELECT name, parser, CASE lower(trim(name)) WHEN 'oai' THEN 'openai' WHEN 'gmn' THEN 'gemini' WHEN 'vtx' THEN 'vertex' END AS provider, CASE WHEN name IS NOT NULL THEN true END AS thinks, contains(name, '2.5') OR contains(name, '2-5') AS plain_thinks FROM n LEFT JOIN a ON lower(name) = alias""",
    "html_sites": SITES,
    "book_pages": f"SELECT book, {strip('book_title')} AS title, 'https://h.example/txt/' || book || '.jpg' AS cover, book AS author, lang || '|' || split_mode || '|' || coalesce(content_type, 'none') AS tags, {strip('book_title')} || {NL} || 'x' || {NL} || 'y' AS synopsis FROM books",
    "catalog_page_links": f"SELECT book, page, id::INTEGER AS id, ((id - 1) // 10 + 1)::INTEGER AS volume, {TITLE} AS title, 'https://h.example/a/c/' || cat_id || '.html' AS url FROM (SELECT *, cat_id // 100 AS page, row_number() OVER (PARTITION BY book, cat_id // 100 ORDER BY cat_id) AS id FROM chapter_catalog)",
    "search_pages": f"SELECT book, {strip('book_title')} || {NL} || 'x & y' AS body, upper(book[1]) || regexp_extract(book, '^.(\\d+_)', 1) || upper(regexp_extract(book, '_(.)', 1)) || regexp_extract(book, '_.(.*)$', 1) AS title, 'https://h.example/b/' || book || '.htm' AS url, 'Latest: ' || {strip('book_title')} AS info FROM books",
    "url_join": "SELECT page_id, form::INTEGER AS form, CASE WHEN form = 7 THEN next_url || '?q=1#f' ELSE next_url END AS url FROM crawl_pages, range(8) r(form) WHERE next_url IS NOT NULL",
    "retried": f"SELECT row_id, '[stub] ' || {strip(RAW)} AS content, true AS ok, 1::INTEGER AS attempts FROM segments WHERE NOT contains({RAW}, '的')",
    "history_upsert": "SELECT DISTINCT ON (path, mode) path AS rel_path, mode, md5(text) AS file_hash, doc_id || 'b' AS output_file FROM (SELECT *, CASE WHEN source = 'yunji_raw' THEN 'web' ELSE 'context' END AS mode FROM documents WHERE crawled_at IS NOT NULL) ORDER BY path, mode, crawled_at DESC, doc_id || 'b' DESC",
    "checkpoint_states": f"""WITH c AS ({CRAWLED}), o AS (SELECT book AS series_name, max(chapter_num) AS chapter_count, NULL::VARCHAR AS last_url, NULL::VARCHAR AS last_title FROM chapter_catalog GROUP BY book),
        s AS (SELECT * FROM c UNION ALL SELECT * FROM o WHERE series_name NOT IN (SELECT series_name FROM c)), l AS (SELECT * FROM s WHERE series_name <> (SELECT min(book) FROM books))
        SELECT b.book AS series_name, l.series_name IS NOT NULL AS found, chapter_count, last_url, last_title FROM books b LEFT JOIN l ON b.book = l.series_name""",
    "loaded_checkpoint": f"SELECT * FROM ({CRAWLED}) WHERE series_name = (SELECT max(book) FROM crawl_pages)",
    "resumed_crawl": "SELECT page_id, book, chapter_num, 'append' AS run FROM crawl_pages WHERE chapter_num IS NOT NULL UNION ALL SELECT page_id, book, chapter_num, 'overwrite' FROM crawl_pages WHERE chapter_num > 10",
    "filter_modes": f"SELECT row_id, mode FROM (SELECT row_id, unnest(['segment', 'chapter', 'off', 'none']) AS mode, {R2} AS g, {R1V} AS v, {R1C} AS c FROM segments) WHERE mode IN ('off', 'none') OR (mode = 'segment' AND g BETWEEN 2 AND 9) OR (mode = 'chapter' AND v BETWEEN 1 AND 999 AND c BETWEEN 2 AND 30)",
    "checked_chapters": f"SELECT row_id, id FROM segments WHERE {R4} - (SELECT min({R4}) FROM segments) BETWEEN 0 AND 3",
    "enabled_pages": "SELECT page_id, success FROM crawl_pages WHERE success IS DISTINCT FROM false",
    "crawl_outcome": "SELECT site, count_if(success IS NOT DISTINCT FROM true)::BIGINT AS n_ok, count_if(success IS DISTINCT FROM true)::BIGINT AS n_failed FROM crawl_pages GROUP BY site",
    "crawl_failures": "SELECT site, page_id FROM crawl_pages WHERE success IS DISTINCT FROM true",
    "batch_files": f"SELECT printf('Ch%03d-%03d', k * 20 + 1, (k + 1) * 20) AS batch_name, count(*) AS n_rows, min(row_id) AS first_row FROM (SELECT row_id, floor(({R1C} - 1) / 20)::INTEGER AS k FROM segments) GROUP BY k",
    "segment_files_read": SEGMENT_FILES,
    "segment_files_strict": f"SELECT path, count(*) AS n_rows, max(ord) AS last FROM ({SEGMENT_FILES}) GROUP BY path",
    "raw_texts": "SELECT doc_id, length(regexp_replace(text, '^\\x{feff}+', ''))::INTEGER AS n, md5(regexp_replace(text, '^\\x{feff}+', '')) AS hash FROM documents WHERE text IS NOT NULL",
    "scanned_files": "SELECT path AS rel_path, n_chars AS length, CASE WHEN string_split(path, '/')[1] = 'yunji_raw' THEN 'WebNovel' ELSE 'LightNovel' END AS content_type FROM documents WHERE n_chars >= 200 AND NOT list_contains(string_split(path, '/')[:-2], 'scanroom') AND string_split(path, '/')[-1] <> '1.txt' AND regexp_matches(path, '\\.(txt|md)$')",
    "latest_file": "SELECT arg_max(path, {'t': crawled_at, 'p': path}) AS path FROM documents WHERE crawled_at IS NOT NULL UNION ALL SELECT 'named.log'",
    "catalog_files_read": f"SELECT DISTINCT ON (path, index) path, index, title, url FROM ({CATALOG_FILES}) WHERE index IS NOT NULL ORDER BY path, index, position DESC",
    "catalog_titles": f"SELECT path, position, title FROM ({CATALOG_FILES})",
    "log_files_read": "SELECT log_file || '/' || (log_id // 100) AS path, row_number() OVER (PARTITION BY log_file, log_id // 100 ORDER BY log_id)::INTEGER AS line_no, line FROM request_log WHERE line IS NOT NULL",
    "book_files": f"""WITH m AS (SELECT book || '_' || (chapter // 10) AS part, chapter, {xml('title')} AS title, list_filter(list_transform({SQUEEZED}, lambda x: {strip(xml('x'))}), lambda x: x <> '') AS ps FROM ({MERGED}))
        SELECT part || '.epub' AS epub, printf('OEBPS/c%05d.xhtml', row_number() OVER (PARTITION BY part ORDER BY chapter)) AS entry, title, len(ps)::INTEGER AS n_paragraphs, md5(array_to_string(ps, {NL})) AS hash FROM m WHERE len(ps) > 0""",
    "interleaved_books": f"SELECT bil_id || '.epub' AS epub, 'item/xhtml/p-002.xhtml' AS entry, len({FILLED})::INTEGER AS n, md5(array_to_string(list_transform({FILLED}, lambda x: x || '|' || {STYLED}), {NL})) AS hash FROM bilingual WHERE content IS NOT NULL",
    "crawl_text": f"""WITH p AS (SELECT page_id, book, row_number() OVER (PARTITION BY book ORDER BY chapter_num NULLS FIRST, page_id)::INTEGER AS position, nullif(trim(coalesce(volume, '')), '') AS v, {NL} || 'Chương ' || coalesce(chapter_num::VARCHAR, '') || ':' || CASE WHEN coalesce(title, '') <> '' THEN ' ' || title ELSE '' END || {MARK} AS block FROM crawl_pages),
        q AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY book ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM p)
        SELECT book, position, CASE WHEN v IS NOT NULL AND v IS DISTINCT FROM o THEN {NL} || v || ':' || {NL} ELSE '' END || block AS block FROM q UNION ALL SELECT DISTINCT book, 0, '=== ' || book || ' ===' || {SEP} FROM crawl_pages""",
    "crawl_file_order": "SELECT page_id, book, chapter_num, row_number() OVER (PARTITION BY book ORDER BY chapter_num NULLS FIRST, page_id)::INTEGER AS position FROM crawl_pages",
    "sequential_text": f"SELECT site, n::INTEGER AS position, 'Chapter ' || n || ': ' || coalesce(title, '') || {NL} || CASE WHEN coalesce(content, '') = '' THEN '(Không có nội dung)' ELSE content END || {SEP} AS block FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page_id) AS n FROM crawl_pages)",
    "log_text": f"""WITH p AS ({PARSED}) SELECT 0 AS part, NULL::BIGINT AS log_id, '=== log ===' || {NL} AS block
        UNION ALL SELECT 1, log_id, '[' || coalesce(ts, '2025-01-01 00:00:00') || '] ' || coalesce(id, '?') || ': ' || CASE WHEN coalesce(status = 'ok', false) THEN 'THÀNH CÔNG | Tokens: In=' || coalesce(in_tokens, 0) || ', Out=' || coalesce(out_tokens, 0) ELSE 'THẤT BẠI - Lỗi: ' || coalesce(error, '') END || {NL} FROM p
        UNION ALL SELECT 2, NULL, {NL} || 'Requests: ' || count(*) || ', failed: ' || count_if(status IS DISTINCT FROM 'ok') || ', tokens in: ' || coalesce(sum(in_tokens), 0) || ', out: ' || coalesce(sum(out_tokens), 0) || {NL} FROM p""",
    "backup_names": "SELECT book, strftime(added_at AT TIME ZONE 'UTC', '%d%m%y_%H%M') || '_backup_' || book || '.yaml' AS name FROM books",
    "all_texts": "SELECT row_id AS n, book, id FROM segments UNION ALL SELECT tr_id, book, id FROM translations",
    "chapter_segments": f"SELECT bil_id, chapter, title, (segment + 1)::INTEGER AS segment, 'Chapter_' || chapter || '_Segment_' || (segment + 1) AS id, '''' || coalesce(title, '') || {SEP} || content AS content FROM ({packed(f'SELECT bil_id, coalesce(ord, 0) AS chapter, title, {FILLED} AS l FROM bilingual', 'bil_id, chapter, title', 300)})",
}
