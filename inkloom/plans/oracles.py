"""SQL for DuckDB that gives the same rows as the registered queries of the core."""

from __future__ import annotations

import unicodedata

# White space and line ends of Unicode text, stated here anew: the SQL shares nothing with the engine.
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
NL = "chr(10)"
HAN = "零一二三四五六七八九十百千"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def num(x: str, p: str, g: int) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '{p}', {g}), '') AS INTEGER)"


def han(x: str) -> str:
    """The value of a Chinese numeral, by summing digit times unit with regular expressions."""
    d = lambda s: f"coalesce(strpos('零一二三四五六七八九', {s}) - 1, 0)"
    unit = lambda u, f: f"CASE WHEN {x} LIKE '%{u}%' THEN {f} * CASE WHEN regexp_matches({x}, '[一二三四五六七八九]{u}') THEN {d(f'''regexp_extract({x}, '([一二三四五六七八九]){u}', 1)''')} ELSE 1 END ELSE 0 END"
    last = f"CASE WHEN regexp_matches({x}, '[一二三四五六七八九]$') THEN {d(f'right({x}, 1)')} ELSE 0 END"
    return f"(CASE WHEN regexp_matches({x}, '^[{HAN[:10]}]+$') THEN TRY_CAST(translate({x}, '{HAN[:10]}', '0123456789') AS INTEGER) WHEN regexp_matches({x}, '^[{HAN}]+$') THEN ({unit('千', 1000)}) + ({unit('百', 100)}) + ({unit('十', 10)}) + ({last}) END)::INTEGER"


def similarity(a: str, b: str) -> str:
    x, y = f"coalesce({a}, '')", f"coalesce({b}, '')"
    shared = f"len(list_intersect(list_distinct(string_split({x}, '')), list_distinct(string_split({y}, ''))))"
    return f"CASE WHEN {x} = '' OR {y} = '' THEN 0.0 WHEN {x} = {y} THEN 1.0 ELSE {shared}::DOUBLE / greatest(length({x}), length({y})) END::DOUBLE"


def band(s: str) -> str:
    return f"CASE WHEN {s} >= 0.9 THEN 'match' WHEN {s} >= 0.7 THEN 'partial' ELSE 'mismatch' END"


DOC_LINES = f"""SELECT doc_id, i::INTEGER AS line_no, {strip('l')} AS line FROM (
    SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS l FROM (SELECT doc_id, regexp_split_to_array(text, '{LINE_END}') AS a FROM documents WHERE text IS NOT NULL))"""

SQUEEZED = f"list_filter(list_transform(string_split(coalesce(content, ''), {NL}), lambda x: {strip(f'''regexp_replace(x, '[{WS}]+', ' ', 'g')''')}), lambda x: x <> '')"

BARE = f"regexp_replace({strip('line')}, '^\\x{{feff}}', '')"
ND = [chr(c) for c in range(128, 0x110000) if unicodedata.category(chr(c)) == "Nd"]
ASCII = "".join(str(unicodedata.digit(c)) for c in ND)


def digits(p: str, g: int = 1, x: str = "b") -> str:
    """The number that a group of a pattern holds, in digits of any script."""
    return f"TRY_CAST(translate(nullif(regexp_extract({x}, '{p}', {g}), ''), '{''.join(ND)}', '{ASCII}') AS INTEGER)"


S = f"[{WS}]*"
N = r"\p{Nd}+"
SPECIAL = f"""CASE WHEN b LIKE '序幕／%' THEN 'prologue' WHEN b LIKE '終幕／%' THEN 'final_chapter'
    WHEN regexp_matches(b, '^(?:里幕|幕间|幕間|特典|短篇|解說|断章|闲谈)') THEN 'interlude'
    WHEN lower(b[1:8]) = 'prologue' AND (length(b) = 8 OR regexp_matches(b[9], '[:{WS}]')) THEN 'prologue' WHEN lower(b[1:8]) = 'epilogue' AND (length(b) = 8 OR regexp_matches(b[9], '[:{WS}]')) THEN 'epilogue'
    WHEN lower(b[1:9]) = 'interlude' AND (length(b) = 9 OR regexp_matches(b[10], '[:{WS}]')) THEN 'interlude' WHEN starts_with(b, '序章') THEN 'prologue' WHEN b[1:2] IN ('后记', '後記') THEN 'epilogue'
    WHEN b[1:2] IN ('前言', '绪言', '引言', '序言') THEN 'foreword' WHEN b[1:2] IN ('终章', '終章', '尾声') THEN 'final_chapter' END"""
NUMBERED = {"Quyển": f"^[Qq]uyển{S}", "Tập": f"^[Tt]ập{S}", "Volume": f"^[Vv]olume{S}", "Vol": f"^[Vv]ol{S}[.]?{S}", "Book": f"^[Bb]ook{S}"}
HAN_VOLUME, ND_VOLUME = f"^第([{HAN}]+)卷", f"^第({N})卷"
VOLUME = f"coalesce({han(f'''nullif(regexp_extract(b, '{HAN_VOLUME}', 1), '')''')}, {digits(ND_VOLUME)}, " + ", ".join(digits(f"{p}({N})") for p in NUMBERED.values()) + ")"


def chapter() -> str:
    """The number of the first form of a chapter heading that a line has."""
    out = "CASE"
    for p in (f"(?i)^chương{S}", "章", f"(?i)^chap{S}", "话", "幕"):
        if len(p) == 1:
            h = f"^第([{HAN}]+){p}"
            out += f" WHEN regexp_matches(b, '{h}') THEN {han(f'''regexp_extract(b, '{h}', 1)''')} WHEN regexp_matches(b, '^第{N}{p}') THEN {digits(f'^第({N}){p}')}"
        else:
            out += f" WHEN regexp_matches(b, '{p}{N}') THEN {digits(f'{p}({N})')}"
    return out + " END"


CHAPTER = chapter()


def vol_title() -> str:
    """A volume heading's title: for 第n卷 a space between the word and the rest, else ``Label n: rest``."""
    out = "CASE"
    for p in (HAN_VOLUME, ND_VOLUME):
        rest = strip(f"regexp_replace(b, '{p}', '')")
        out += f" WHEN regexp_matches(b, '{p}') THEN '第' || regexp_extract(b, '{p}', 1) || '卷' || CASE WHEN {rest} = '' THEN '' ELSE ' ' || {rest} END"
    for label, p in NUMBERED.items():
        rest = strip(f"regexp_replace(b, '{p}{N}[.:]?', '')")
        out += f" WHEN regexp_matches(b, '{p}{N}') THEN '{label} ' || {digits(f'{p}({N})')} || CASE WHEN {rest} = '' THEN '' ELSE ': ' || {rest} END"
    return out + " END"


def bracketed(word: str) -> str:
    return f"'{word}' || CASE WHEN regexp_matches(b, '{word}[「『].+?[」』]') THEN ': ' || regexp_extract(b, '{word}[「『](.+?)[」』]', 1) ELSE '' END"


SPECIAL_TITLE = f"CASE WHEN starts_with(b, '序章') THEN {bracketed('序章')} WHEN b[1:2] IN ('终章', '終章', '尾声') THEN {bracketed('终章')} ELSE {strip('b')} END"


def heads(rows: str) -> str:
    """``rows`` (with b, the line without white space around it and without a byte-order mark) and kind, number, title."""
    return f"""SELECT *, CASE kind WHEN 'volume' THEN v WHEN 'chapter' THEN c END AS number, CASE kind WHEN 'volume' THEN {vol_title()} WHEN 'chapter' THEN {strip('b')} WHEN 'body' THEN NULL ELSE {SPECIAL_TITLE} END AS title
        FROM (SELECT *, CASE WHEN s IS NOT NULL THEN s WHEN v > 0 THEN 'volume' WHEN c > 0 AND c <= 5000 THEN 'chapter' ELSE 'body' END AS kind FROM (SELECT *, {SPECIAL} AS s, {VOLUME} AS v, {CHAPTER} AS c FROM ({rows})))"""


HEADINGS = f"SELECT doc_id, line_no, line, kind, number, title FROM ({heads(f'SELECT *, {BARE} AS b FROM ({DOC_LINES})')})"
W = "(PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)"
WV = "(PARTITION BY doc_id, vk ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def sections(strict: bool = False) -> str:
    """Sections by windows over the lines: volume, repeated chapters, numbers by volume, edges, then one row for each."""
    tight = "dup AND coalesce(above = 1, false)" if strict else "false"
    return f"""
    WITH h AS ({HEADINGS}),
    a AS (SELECT *, count_if(kind = 'volume') OVER {W} AS run, last_value(CASE WHEN kind = 'volume' THEN number END IGNORE NULLS) OVER {W} AS volume FROM h),
    b AS (SELECT *, kind = 'chapter' AND row_number() OVER (PARTITION BY doc_id, run, CASE WHEN kind = 'chapter' THEN number END ORDER BY line_no) > 1 AS dup, coalesce(volume, 0) AS vk FROM a),
    c AS (SELECT *, kind <> 'body' AND NOT dup AS kept, lag(CASE WHEN line = '' THEN 0 WHEN dup THEN 2 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS above FROM b),
    d AS (SELECT *, coalesce(max(CASE WHEN kept AND kind = 'chapter' THEN number END) OVER {WV}, 0) AS top, coalesce(count_if(kind = 'final_chapter') OVER {WV}, 0) AS finals, coalesce(count_if(kind = 'interlude') OVER {WV}, 0) AS inters FROM c),
    e0 AS (SELECT *, CASE WHEN NOT kept THEN NULL WHEN kind IN ('volume', 'prologue') THEN 0 WHEN kind = 'chapter' THEN number WHEN kind IN ('final_chapter', 'epilogue') THEN top + 1 + finals WHEN kind = 'interlude' THEN 901 + inters END AS n FROM d),
    e AS (SELECT *, CASE WHEN volume IS NULL THEN '' ELSE 'Volume_' || volume || '_' END AS pre FROM e0),
    f0 AS (SELECT *, CASE WHEN kind = 'volume' THEN 'Volume_' || volume WHEN kind = 'foreword' THEN pre || 'foreword' ELSE pre || 'Chapter_' || n END AS sid FROM e),
    f AS (SELECT *, coalesce(last_value(n IGNORE NULLS) OVER {W}, 0)::INTEGER AS chapter, coalesce(last_value(CASE WHEN kept THEN title END IGNORE NULLS) OVER {W}, '') AS head, coalesce(last_value(CASE WHEN kept THEN sid END IGNORE NULLS) OVER {W}, 'none') AS hid, count_if(kept OR ({tight})) OVER {W} AS section FROM f0),
    s AS (SELECT doc_id, section::INTEGER AS section, arg_min(hid, line_no) AS section_id, any_value(volume) AS volume, arg_min(chapter, line_no) AS chapter, arg_min(head, line_no) AS title, list(CASE WHEN kept THEN title ELSE line END ORDER BY line_no) AS lines FROM f WHERE line <> '' AND NOT dup GROUP BY doc_id, section HAVING count(*) > 1)"""


SECTIONS = sections()
SECTION_ROWS = "SELECT doc_id, section, section_id, volume, chapter, title, len(lines)::INTEGER AS n_lines, array_to_string(lines, chr(10)) AS text FROM s"


def greedy(most: int) -> str:
    """The segment of each line of the list ``l``, by folding over the sizes."""
    sizes = f"list_transform(l, lambda x: {{'cur': length(regexp_replace(x, '[{WS}]+', '', 'g')), 'k': 0, 'ks': [0]}})"
    step = f"lambda a, x: CASE WHEN a.cur + x.cur > {most} AND a.cur > 0 THEN {{'cur': x.cur, 'k': a.k + 1, 'ks': list_append(a.ks, a.k + 1)}} ELSE {{'cur': a.cur + x.cur, 'k': a.k, 'ks': list_append(a.ks, a.k)}} END"
    return f"list_reduce({sizes}, {step}).ks"


def packed(rows: str, keys: str, most: int) -> str:
    return f"""SELECT {keys}, k::INTEGER AS segment, string_agg(x, {NL} || {NL} ORDER BY i) AS content FROM (
        SELECT {keys}, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x, unnest(ks) AS k FROM (SELECT *, {greedy(most)} AS ks FROM ({rows}) WHERE len(l) > 0)) GROUP BY ALL"""


NONSPACE = f"length(regexp_replace(content, '[{WS}]+', '', 'g'))"
DOC_PACKED = packed(f"SELECT doc_id, lang, list_filter(list_transform(regexp_split_to_array(text, '{LINE_END}'), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents", "doc_id, lang", 2000)
BODY = "CASE WHEN len(lines) >= 2 AND lines[2] = {t} THEN lines[3:] ELSE lines[2:] END"

VC = r"(?:Volume_(\d+)_)?Chapter_(\d+)"
R1V = f"(CASE WHEN regexp_matches(id, '{VC}') THEN coalesce({num('id', VC, 1)}, 1) ELSE 1 END)::INTEGER"
R1C = f"coalesce({num('id', VC, 2)}, 0)::INTEGER"
R2 = f"coalesce({num('id', r'Segment_(\d+)', 1)}, 0)::INTEGER"
R3 = r"nullif(regexp_extract(id, '((?:Volume_\d+_)?Chapter_\d+)', 1), '')"
R4 = num("id", r"^Chapter_(\d+)_Segment_\d+", 1)
R5 = num("id", r"Chapter_(\d+)", 1)
VCS6, VC6, CS6, C6 = r"(?i)Volume_(\d+)_Chapter_(\d+)_Segment_(\d+)", r"(?i)Volume_(\d+)_Chapter_(\d+)", r"(?i)Chapter_(\d+)_Segment_(\d+)", r"(?i)Chapter_(\d+)"
R6V = f"coalesce({num('id', VCS6, 1)}, {num('id', VC6, 1)})"
R6C = f"coalesce({num('id', VCS6, 2)}, {num('id', VC6, 2)}, {num('id', CS6, 1)}, {num('id', C6, 1)})"
R6S = f"(CASE WHEN regexp_matches(id, '{VCS6}') THEN {num('id', VCS6, 3)} WHEN regexp_matches(id, '{VC6}') THEN NULL ELSE {num('id', CS6, 2)} END)"
R7 = r"nullif(regexp_extract(id, '(Chapter_\d+)_Segment_\d+', 1), '')"
DIG = r"regexp_extract_all({x}, '\d+')"
R8A = f"(CASE WHEN len({DIG.format(x='id')}) >= 2 THEN TRY_CAST({DIG.format(x='id')}[1] AS INTEGER) ELSE 0 END)::INTEGER"
R8B = f"(CASE WHEN len({DIG.format(x='id')}) >= 2 THEN TRY_CAST({DIG.format(x='id')}[2] AS INTEGER) WHEN len({DIG.format(x='id')}) = 1 THEN TRY_CAST({DIG.format(x='id')}[1] AS INTEGER) ELSE 0 END)::INTEGER"

SEP = f"{NL} || {NL}"
MERGED = f"""SELECT book, chapter, 'Chapter_' || chapter AS id, coalesce(t, 'Chapter ' || chapter) AS title, content, n_segments FROM (
    SELECT book, {R4} AS chapter, first(title ORDER BY ord, row_id) AS t, coalesce(string_agg(content, {SEP} ORDER BY ord, row_id), '') AS content, count(*) AS n_segments FROM segments WHERE {R4} IS NOT NULL GROUP BY 1, 2)"""
NESTED = f"SELECT book, {R5} AS chapter_number, first(title ORDER BY ord, row_id) AS chapter_title, count(*) AS total_segments, list(id ORDER BY ord, row_id) AS ids, list(length(coalesce(content, '')) ORDER BY ord, row_id) AS lengths FROM segments WHERE {R5} IS NOT NULL GROUP BY 1, 2"


FIRST = f"list_filter(string_split(coalesce(content, ''), {NL}), lambda x: length(regexp_replace(x, '[{WS}]+', '', 'g')) > 0)[1]"
NEW_TITLE = "nullif(" + strip("regexp_replace(" + strip(FIRST) + ", '^''', '')") + ", '')"
AT = f"list_position(list_transform(string_split(coalesce(content, ''), {NL}), lambda x: length(regexp_replace(x, '[{WS}]+', '', 'g')) > 0), true)"
REST = f"regexp_replace(array_to_string(string_split(coalesce(content, ''), {NL})[{AT} + 1:], {NL}), '^(?:[{WS}]*\\n)+', '')"

FAILED = """SELECT log_id, log_file, regexp_extract(line, '^[^\\]]*\\] (.*?): THẤT BẠI', 1) AS id FROM request_log WHERE contains(line, ': THẤT BẠI')"""
FAILED = f"SELECT * FROM ({FAILED}) WHERE id <> '' AND NOT starts_with(id, 'Title_')"
LAST_CATALOG = "SELECT DISTINCT ON (book, chapter_num) * FROM chapter_catalog ORDER BY book, chapter_num, cat_id DESC"
COMPARED = f"SELECT p.page_id, c.title AS listed, p.title FROM crawl_pages p JOIN ({LAST_CATALOG}) c ON p.book = c.book AND p.chapter_num = c.chapter_num"
LAST_DONE = "SELECT DISTINCT ON (book, id) * FROM translations WHERE book IS NOT NULL AND id IS NOT NULL ORDER BY book, id, tr_id DESC"
PARSED = r"""SELECT log_id, log_file, nullif(regexp_extract(line, '^\[(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)\]', 1), '') AS ts, nullif(regexp_extract(line, '^\[[^\]]*\] (.*?): (?:THÀNH CÔNG|THẤT BẠI)', 1), '') AS id,
    CASE WHEN contains(line, ': THÀNH CÔNG') THEN 'ok' WHEN contains(line, ': THẤT BẠI') THEN 'failed' END AS status,
    TRY_CAST(nullif(regexp_extract(line, 'In=(\d+)', 1), '') AS BIGINT) AS in_tokens, TRY_CAST(nullif(regexp_extract(line, 'Out=(\d+)', 1), '') AS BIGINT) AS out_tokens, nullif(regexp_extract(line, 'Lỗi: (.*)$', 1), '') AS error FROM request_log"""
PLAN = """
    WITH f AS (SELECT path AS rel_path, md5(text) AS file_hash, lang, source, crawled_at FROM documents), m AS (SELECT unnest(['context', 'web']) AS mode),
    h AS (SELECT rel_path, CASE WHEN source = 'yunji_raw' THEN 'web' ELSE 'context' END AS mode, CASE WHEN lang = 'zh' THEN file_hash ELSE md5(lang) END AS file_hash, crawled_at FROM f WHERE lang IS NOT NULL),
    s AS (SELECT rel_path, arg_max_null(file_hash, crawled_at) AS old_hash, list(DISTINCT mode) AS done FROM h GROUP BY 1), o AS (SELECT DISTINCT rel_path, mode, true AS made FROM f, m WHERE source <> 'scanroom'),
    p AS (SELECT f.rel_path, m.mode, CASE WHEN made IS NULL THEN 'no output' WHEN done IS NULL THEN 'untracked' WHEN NOT list_contains(done, m.mode) THEN 'mode missing' WHEN old_hash IS DISTINCT FROM file_hash THEN 'changed' ELSE 'up to date' END AS reason
        FROM f CROSS JOIN m LEFT JOIN s ON f.rel_path = s.rel_path LEFT JOIN o ON o.rel_path = f.rel_path AND o.mode = m.mode)"""
STEM = "regexp_replace(book, '^b', '')"
KEY = lambda x: f"regexp_replace(lower({x}), '_?\\d+$', '')"
LONG = "book_title || ' / ' || book_title || ' / ' || book_title"
HTML = f"'<h1>' || coalesce(title, '') || '</h1><script>var s = \"</p>\";</script><p>' || replace(coalesce(content, ''), {NL}, '<br/>') || '</p>&nbsp;&amp;'"
ENT = "replace(replace(replace(replace(replace(replace({x}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
NOTAGS = f"regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'), '(?i)<br\\s*/?>', {NL}, 'g'), '(?s)<[^>]*>', '', 'g')"

SQL: dict[str, str] = {
    "split_lines": f"SELECT * FROM ({DOC_LINES}) WHERE line <> ''",
    "nonspace_len": f"SELECT doc_id, length(regexp_replace(text, '[{WS}]+', '', 'g'))::INTEGER AS n FROM documents",
    "clean_text": f"SELECT row_id, array_to_string({SQUEEZED}, {SEP}) AS content FROM segments",
    "clean_answer": f"""
        WITH u AS (SELECT tr_id, replace(replace(replace(replace(coalesce(content, ''), '\\n', {NL}), '\\"', '"'), '\\\\', '\\'), '\\' || {NL} || '\\', {NL}) AS t FROM translations),
        l AS (SELECT tr_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS x FROM (SELECT tr_id, string_split(t, {NL}) AS a FROM u)),
        s AS (SELECT tr_id, i, {strip(f'''regexp_replace(x, '[{WS}]+', ' ', 'g')''')} AS x FROM l),
        m AS (SELECT *, CASE WHEN starts_with(x, '<think>') THEN 1 WHEN starts_with(x, '</think>') THEN 0 END AS mark FROM s),
        o AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY tr_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM m)
        SELECT tr_id, coalesce(string_agg(CASE WHEN open = 0 AND mark IS NULL AND x <> '' THEN x END, {SEP} ORDER BY i), '') AS content FROM o GROUP BY tr_id""",
    "base_clean": f"SELECT page_id, {strip(f'''regexp_replace(regexp_replace(content, '[\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{feff}}]', '', 'g'), '\\n[{WS}]*\\n[{WS}]*\\n+', {NL} || {NL}, 'g')''')} AS content FROM crawl_pages",
    "xml_clean": r"SELECT page_id, regexp_replace(content, '[^\x{9}\x{A}\x{D}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]', '', 'g') AS content FROM crawl_pages",
    "para_html": f"SELECT row_id, array_to_string(list_transform(list_filter(list_transform(string_split(replace(replace(replace(content, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), {SEP}), lambda x: {strip('x')}), lambda x: x <> ''), lambda x: '<p>' || replace(x, {NL}, '<br/>') || '</p>'), {NL}) AS html FROM segments",
    "sentence_paragraphs": f"""WITH p AS (SELECT row_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content, '([。！？])([^{WS}])', '\\1' || {SEP} || '\\2', 'g'), '(["」])([^{WS}])', '\\1' || {SEP} || '\\2', 'g'), '([。！？])[{WS}]+([^{WS}])', '\\1' || {SEP} || '\\2', 'g'), '(["」])[{WS}]+([^{WS}])', '\\1' || {SEP} || '\\2', 'g'), '\\n{{3,}}', {SEP}, 'g') AS t FROM segments),
        l AS (SELECT row_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS x FROM (SELECT row_id, list_transform(string_split(t, {NL}), lambda x: {strip('x')}) AS a FROM p)),
        k AS (SELECT *, lag(x) OVER (PARTITION BY row_id ORDER BY i) AS before FROM l), m AS (SELECT row_id, string_agg(CASE WHEN i = 1 THEN '''' || x ELSE x END, {NL} ORDER BY i) AS content FROM k WHERE x <> '' OR coalesce(before, '') <> '' GROUP BY row_id)
        SELECT s.row_id, CASE WHEN s.content IS NULL THEN NULL ELSE coalesce(m.content, '') END AS content FROM segments s LEFT JOIN m ON s.row_id = m.row_id""",
    "id_parse_all": f"SELECT row_id, {R1V} AS r1_volume, {R1C} AS r1_chapter, {R2} AS r2_segment, {R3} AS r3_key, {R4} AS r4_chapter, {R5} AS r5_chapter, {R6V} AS r6_volume, {R6C} AS r6_chapter, {R6S} AS r6_segment, {R7} AS r7_key, {R8A} AS r8_major, {R8B} AS r8_minor FROM segments",
    "output_names": f"""SELECT book, {KEY('book')} AS name_key, regexp_replace(book_title, '[^\\p{{L}}\\p{{N}}\\p{{M}}_\\-.]', '_', 'g') AS safe_name,
        CASE WHEN coalesce(content_type, '') = '' OR starts_with({KEY(STEM)}, {KEY("coalesce(content_type, '')")}) THEN {STEM} ELSE content_type || '_' || {STEM} END || '_context.yaml' AS output_name,
        book || '_' || split_mode || '_split.yaml' AS split_name, strftime(added_at AT TIME ZONE 'UTC', '%d%m%y_%H%M') || '_oai_' || book || '_' || split_mode || '.yaml' AS stamped_name,
        CASE WHEN length({LONG}) > 50 THEN substr({LONG}, 1, 47) || '...' ELSE {LONG} END AS shortened, substr(book || '_secret_' || book, 1, 10) || '...' || right(book, 4) AS masked FROM books""",
    "detect_headings": f"SELECT doc_id, line_no, kind, number, title FROM ({HEADINGS}) WHERE kind <> 'body'",
    "sections_strict": f"{sections(True)} {SECTION_ROWS}",
    "sections_from_lines": f"{SECTIONS} {SECTION_ROWS}",
    "out_of_order_chapters": f"""SELECT book, line_no, previous, number FROM (SELECT book, page_id AS line_no, number, lag(number) OVER (PARTITION BY book ORDER BY page_id) AS previous FROM (
        SELECT book, page_id, {CHAPTER} AS number FROM (SELECT book, page_id, regexp_replace({strip("title")}, '^\\x{{feff}}', '') AS b FROM crawl_pages)) WHERE number <= 5000) WHERE previous IS NOT NULL AND number <> previous + 1 AND number <> 1""",
    "chapter_classes": f"""SELECT cat_id, CASE WHEN c THEN 'chapter' ELSE 'interlude' END AS type, coalesce({han(f"nullif(regexp_extract(b, '^第([{HAN}]+)章', 1), '')")}, {digits('^第(\\p{Nd}{1,3})章')}) AS number, b AS title, NOT c AS is_special FROM (
        SELECT cat_id, b, regexp_matches(b, '^第[{HAN}]+章') OR regexp_matches(b, '^第\\p{{Nd}}{{1,3}}章') AS c FROM (SELECT cat_id, coalesce(regexp_replace({strip("title")}, '^\\x{{feff}}', ''), '') AS b FROM chapter_catalog))""",
    "content_types": "SELECT doc_id, CASE string_split(path, '/')[1] WHEN 'yunji_raw' THEN 'WebNovel' WHEN 'moque_raw' THEN 'Urban' WHEN 'oldforum_raw' THEN 'Forum' ELSE 'LightNovel' END AS content_type FROM documents",
    "file_titles": r"""SELECT log_id, coalesce(TRY_CAST(nullif(regexp_extract(log_file, '(\d+)', 1), '') AS INTEGER) - 2, log_id)::INTEGER AS chapter, CASE WHEN len(kept) > 0 THEN array_to_string(list_transform(kept, lambda x: upper(x[1]) || lower(x[2:])), ' ') END AS title FROM (
        SELECT log_id, log_file, list_transform(list_filter(list_zip(p, range(1, len(p) + 1)), lambda z: NOT regexp_matches(z[1], '^\d+$') AND NOT coalesce(z[2] > 1 AND regexp_matches(p[z[2] - 1], '^\d{6}$'), false) AND lower(z[1]) NOT IN ('context', 'titles') AND z[1] <> ''), lambda z: z[1]) AS kept FROM (
        SELECT log_id, log_file, string_split(regexp_replace(replace(regexp_replace(log_file, '\.log$', ''), '-', ''), '^\d\d', ''), '_') AS p FROM request_log))""",
    "pack_segments": f"SELECT doc_id, segment, {NONSPACE}::INTEGER AS n_chars, content FROM ({DOC_PACKED})",
    "pack_stats_by_lang": f"SELECT lang, count(*) AS n_segments, count(DISTINCT doc_id) AS n_docs, sum({NONSPACE})::BIGINT AS n_chars, max({NONSPACE})::INTEGER AS largest FROM ({DOC_PACKED}) GROUP BY lang",
    "section_segments": f"""{SECTIONS}, t AS (SELECT doc_id, section, volume, chapter, lines[1] AS title, {BODY.format(t='lines[1]')} AS l FROM s),
        p AS ({packed('SELECT * FROM t', 'doc_id, section, volume, chapter, title', 500)})
        SELECT doc_id, n::INTEGER AS ord, CASE WHEN volume IS NULL THEN '' ELSE 'Volume_' || volume || '_' END || 'Chapter_' || chapter || '_Segment_' || n AS id, title, '''' || title || {SEP} || content AS content
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY volume ASC NULLS LAST, chapter, section, segment) AS n FROM p)""",
    "section_simple_segments": f"""{SECTIONS}, t AS (SELECT doc_id, section, title, array_to_string({BODY.format(t='title')}, {SEP}) AS body FROM s)
        SELECT doc_id, n::INTEGER AS ord, 'Segment_' || n AS id, title, '''' || title || {SEP} || body AS content FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section) AS n FROM t WHERE body <> '')""",
    "section_plain_segments": f"""{SECTIONS}, t AS (SELECT doc_id, section, chapter, lines[1] AS title, lines[2:] AS l FROM s), p AS ({packed('SELECT * FROM t', 'doc_id, section, chapter, title', 800)})
        SELECT doc_id, n::INTEGER AS ord, 'Chapter_' || chapter || '_Segment_' || n AS id, title, content FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section, segment) AS n FROM p)""",
    "section_text_segments": f"{SECTIONS} SELECT doc_id, n::INTEGER AS ord, 'Segment_' || n AS id, title, array_to_string(lines[2:], {SEP}) AS content FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section) AS n FROM s)",
    "section_text_layout": f"""{SECTIONS}, t AS (SELECT doc_id, section, chapter, lines[1] AS title, lines[2:] AS l FROM s), p AS ({packed('SELECT * FROM t', 'doc_id, section, chapter, title', 800)})
        SELECT doc_id, string_agg('Chapter_' || chapter || '_Segment_' || n || {NL} || title || {NL} || content || {SEP} || {NL}, '' ORDER BY n) AS text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section, segment) AS n FROM p) GROUP BY doc_id""",
    "section_simple_layout": f"{SECTIONS} SELECT doc_id, string_agg('Segment_' || n || {NL} || title || {NL} || array_to_string(list_transform(lines[2:], lambda x: x || {SEP}), '') || {NL}, '' ORDER BY n) AS text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section) AS n FROM s) GROUP BY doc_id",
    "merge_chapters": MERGED,
    "chapter_json": f"SELECT book, chapter_number, chapter_title, total_segments, array_to_string(ids, '|') AS ids, array_to_string(lengths, '|') AS lengths FROM ({NESTED})",
    "chapter_index": f"SELECT book, count(*) AS total_chapters, sum(total_segments)::BIGINT AS total_segments, string_agg('chapter_' || lpad(chapter_number::VARCHAR, greatest(3, length(chapter_number::VARCHAR))::INTEGER, '0') || '.json:' || total_segments, '|' ORDER BY chapter_number) AS files FROM ({NESTED}) GROUP BY book",
    "epub_order": f"""SELECT *, row_number() OVER (PARTITION BY book ORDER BY {R8A.replace('id', 'chapter_key')}, {R8B.replace('id', 'chapter_key')}, chapter_key)::INTEGER AS position FROM (
        SELECT book, {R3} AS chapter_key, first(title ORDER BY ord, row_id) AS title, string_agg(CASE WHEN {strip('content')} <> '' THEN content END, {SEP} ORDER BY ord, row_id) AS content FROM segments WHERE {R3} IS NOT NULL GROUP BY 1, 2) WHERE {strip('content')} <> ''""",
    "txt_order": f"""SELECT book, volume, chapter, CASE WHEN volume IS NULL THEN '' ELSE 'Quyển ' || volume || ' - ' END || 'Chương ' || chapter || ': ' || coalesce(title, '') AS header, text, row_number() OVER (PARTITION BY book ORDER BY volume ASC NULLS LAST, chapter)::INTEGER AS position FROM (
        SELECT book, {R6V} AS volume, {R6C} AS chapter, first(title ORDER BY ord, row_id) AS title, coalesce(string_agg(content, {SEP} ORDER BY coalesce({R6S}, 0), ord, row_id), '') AS text FROM segments WHERE {R6C} IS NOT NULL GROUP BY 1, 2, 3)""",
    "upload_plan_topn": f"""WITH s AS (SELECT *, regexp_extract(id, '(Volume_1_Chapter_\\d+)_', 1) AS chapter_key, {R2} AS g FROM segments), k AS (SELECT *, TRY_CAST(regexp_extract(chapter_key, 'Chapter_(\\d+)', 1) AS INTEGER) AS chapter FROM s WHERE chapter_key <> ''),
        r AS (SELECT *, dense_rank() OVER (PARTITION BY book ORDER BY chapter) AS r FROM k)
        SELECT book, chapter_key, chapter, first(title ORDER BY g, ord, row_id) AS title, coalesce(string_agg(content, {SEP} ORDER BY g, ord, row_id), '') AS content FROM r WHERE r <= 3 GROUP BY 1, 2, 3""",
    "upload_files": f"""SELECT book, {R7} AS chapter_key, {R5} AS chapter, first(title ORDER BY {R2}, ord, row_id) AS title, coalesce(string_agg(content, {SEP} ORDER BY {R2}, ord, row_id), '') AS content FROM segments WHERE {R7} IS NOT NULL GROUP BY 1, 2, 3""",
    "add_segment_suffix": f"SELECT book, id || '_Segment_' || chapter AS id, replace({strip('content')}, {NL}, {SEP}) AS content FROM ({MERGED})",
    "unique_chapter_titles": f"SELECT book, {R3} AS chapter_key, first(title ORDER BY ord, row_id) AS title FROM segments WHERE {R3} IS NOT NULL AND {strip("coalesce(title, '')")} <> '' GROUP BY 1, 2",
    "first_line_title": f"SELECT row_id, coalesce({NEW_TITLE}, title) AS title FROM segments",
    "first_line_title_removed": f"SELECT row_id, coalesce({NEW_TITLE}, title) AS title, CASE WHEN {NEW_TITLE} IS NULL THEN content ELSE {REST} END AS content FROM segments",
    "catalog_numbering": "SELECT cat_id, book, id::INTEGER AS id, (floor((id - 1) / 100) + 1)::INTEGER AS volume FROM (SELECT cat_id, book, row_number() OVER (PARTITION BY book ORDER BY cat_id) AS id FROM chapter_catalog)",
    "multi_url_merge": f"""WITH l AS (SELECT book, chapter_num, unnest(range(len(u))) AS nth, unnest(u) AS url FROM (SELECT book, chapter_num, coalesce(urls, [url]) AS u FROM ({LAST_CATALOG}))),
        p AS (SELECT DISTINCT ON (url) url, title, volume, content FROM crawl_pages WHERE success AND content <> '' ORDER BY url, page_id DESC), b AS (SELECT l.book, l.chapter_num, nth, title, volume, content FROM l JOIN p ON l.url = p.url)
        SELECT book, chapter_num, coalesce(max(CASE WHEN nth = 0 THEN title END), '') AS title, coalesce(max(CASE WHEN nth = 0 THEN volume END), '') AS volume, count(*) AS n_pages, string_agg(CASE WHEN nth > 0 AND coalesce(title, '') <> '' THEN title || {SEP} || content ELSE content END, {SEP} ORDER BY nth) AS content FROM b GROUP BY 1, 2""",
    "volume_change_marker": f"""SELECT page_id, book, chapter_num, volume FROM (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY book ORDER BY chapter_num NULLS FIRST, page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM (SELECT *, CASE WHEN {strip("coalesce(volume, '')")} <> '' THEN volume END AS v FROM crawl_pages)) WHERE v IS NOT NULL AND v IS DISTINCT FROM p""",
    "next_chain": """WITH RECURSIVE one AS (SELECT url, arg_max_null(next_url, {'s': coalesce(success, false), 'p': page_id}) AS nxt, max(coalesce(success, false)) AS ok FROM crawl_pages WHERE url IS NOT NULL GROUP BY url),
        walk AS (SELECT 1 AS step, url, [url] AS seen, nxt FROM one WHERE ok AND url = (SELECT arg_min(url, cat_id) FROM chapter_catalog WHERE url <> '')
            UNION ALL SELECT w.step + 1, o.url, list_append(w.seen, o.url), o.nxt FROM walk w JOIN one o ON o.url = w.nxt WHERE o.ok AND NOT list_contains(w.seen, o.url))
        SELECT step, url FROM walk""",
    "long_chain": "SELECT row_number() OVER (ORDER BY page_id)::INTEGER AS step, 'p' || row_number() OVER (ORDER BY page_id) AS url FROM (SELECT DISTINCT page_id FROM crawl_pages)",
    "catalog_volumes": "SELECT book, ceil(count(*) / 100)::BIGINT AS n_volumes, count(*) AS n_chapters, 1::INTEGER AS first_volume, ceil(count(*) / 100)::INTEGER AS last_volume FROM chapter_catalog GROUP BY book",
    "bilingual_split": f"""WITH l AS (SELECT book, id, bil_id, CASE WHEN lang = 'zh' THEN 'JP' ELSE 'ZH' END AS lang, unnest(range(len(a))) AS i, unnest(a) AS x FROM (SELECT *, list_filter(list_transform(string_split(content, {NL}), lambda x: {strip('x')}), lambda x: x <> '') AS a FROM bilingual WHERE content IS NOT NULL)),
        n AS (SELECT *, row_number() OVER (PARTITION BY book, id ORDER BY i, bil_id, x) AS n, count(*) OVER (PARTITION BY book, id) AS total FROM l), k AS (SELECT DISTINCT book, id, unnest(['JP', 'ZH']) AS lang FROM n WHERE total >= 2)
        SELECT k.book, k.id, k.lang, arg_max(CASE WHEN n.lang = k.lang AND n <= 2 THEN x END, CASE WHEN n.lang = k.lang AND n <= 2 THEN n END) AS title, count_if(n.lang = k.lang AND n > 2)::INTEGER AS n_lines, coalesce(string_agg(CASE WHEN n.lang = k.lang AND n > 2 THEN x END, {NL} ORDER BY n), '') AS text FROM k JOIN n ON n.book = k.book AND n.id = k.id GROUP BY 1, 2, 3""",
    "chapter_range": f"SELECT row_id, id FROM segments WHERE {R1V} BETWEEN 1 AND 2 AND {R1C} BETWEEN 3 AND 40",
    "segment_range": f"SELECT row_id, id FROM segments WHERE {R2} BETWEEN 5 AND 25",
    "chapter_bounds": f"SELECT book, min({R4}) AS first_chapter, max({R4}) AS last_chapter FROM segments WHERE {R4} IS NOT NULL GROUP BY book",
    "catalog_slice": "SELECT * FROM (SELECT book, cat_id, chapter_num, row_number() OVER (PARTITION BY book ORDER BY chapter_num NULLS FIRST, cat_id)::INTEGER AS position FROM chapter_catalog) WHERE position BETWEEN 2 AND 6",
    "bucket_volume": f"SELECT row_id, {R1V} AS batch_no, 'Vol' || {R1V} AS batch_name FROM segments",
    "bucket_aligned": f"SELECT row_id, k AS batch_no, printf('Ch%03d-%03d', k * 20 + 1, (k + 1) * 20) AS batch_name FROM (SELECT row_id, floor(({R1C} - 1) / 20)::INTEGER AS k FROM segments)",
    "bucket_from_min": f"""SELECT row_id, k AS batch_no, (lo + k * 15) || '_' || least(lo + k * 15 + 14, hi) || '.yaml' AS batch_name FROM (SELECT row_id, lo, hi, floor((c - lo) / 15)::INTEGER AS k FROM (SELECT row_id, {R4} AS c, min({R4}) OVER (PARTITION BY book) AS lo, max({R4}) OVER (PARTITION BY book) AS hi FROM segments WHERE {R4} IS NOT NULL))""",
    "batch_totals": f"""SELECT *, sum(n_rows) OVER (ORDER BY batch_no)::BIGINT AS rows_so_far FROM (SELECT k AS batch_no, printf('Ch%03d-%03d', k * 20 + 1, (k + 1) * 20) AS batch_name, count(*) AS n_rows, count(content) AS n_ok, count(*) - count(content) AS n_failed FROM (SELECT content, floor(({R1C} - 1) / 20)::INTEGER AS k FROM translations) GROUP BY 1)""",
    "restore_order_fallback": f"SELECT s.row_id, s.book, s.ord, s.id, CASE WHEN t.tr_id IS NULL THEN s.title ELSE t.title END AS title, CASE WHEN t.tr_id IS NULL THEN s.content ELSE t.content END AS content, t.tr_id IS NOT NULL AS translated FROM segments s LEFT JOIN ({LAST_DONE}) t ON s.book = t.book AND s.id = t.id",
    "patch_failed": f"SELECT b.bil_id, b.book, b.id, CASE WHEN t.tr_id IS NULL THEN b.title ELSE t.title END AS title, CASE WHEN t.tr_id IS NULL THEN b.content ELSE t.clean END AS content, t.tr_id IS NOT NULL AS patched FROM bilingual b LEFT JOIN (SELECT t.*, c.clean FROM ({LAST_DONE}) t JOIN (CLEANED) c USING (tr_id)) t ON b.book = t.book AND b.id = t.id",
    "merge_titles": f"SELECT s.row_id, coalesce(t.title, s.title) AS title FROM (SELECT *, {R3} AS k FROM segments) s LEFT JOIN (SELECT book, {R3} AS k, first(title ORDER BY tr_id) AS title FROM translations WHERE {R3} IS NOT NULL AND {strip("coalesce(title, '')")} <> '' GROUP BY 1, 2) t ON s.book = t.book AND s.k = t.k",
    "failed_ids": FAILED,
    "failed_sources": f"SELECT f.log_id, f.book, f.id, s.row_id, s.title, s.content FROM (SELECT log_id, id, regexp_extract(log_file, '_[a-z]+_(b\\d+_[a-z]+)\\.log$', 1) AS book FROM ({FAILED})) f JOIN (SELECT DISTINCT ON (book, id) * FROM segments ORDER BY book, id, ord, row_id) s ON f.book = s.book AND f.id = s.id",
    "untranslated": "SELECT book, id FROM segments EXCEPT SELECT book, id FROM translations",
    "catalog_coverage": "SELECT *, 'missing' AS status FROM (SELECT book, chapter_num FROM crawl_pages EXCEPT SELECT book, chapter_num FROM chapter_catalog) UNION ALL SELECT *, 'extra' FROM (SELECT book, chapter_num FROM chapter_catalog EXCEPT SELECT book, chapter_num FROM crawl_pages)",
    "catalog_lookup": f"SELECT p.page_id, p.book, p.chapter_num, c.url FROM crawl_pages p LEFT JOIN ({LAST_CATALOG}) c ON p.book = c.book AND p.chapter_num = c.chapter_num",
    "catalog_by_number": r"SELECT DISTINCT ON (book, number) book, number, title, url FROM (SELECT *, TRY_CAST(nullif(regexp_extract(title, '^第(\d+)章', 1), '') AS INTEGER) AS number FROM chapter_catalog) WHERE number IS NOT NULL ORDER BY book, number, cat_id DESC",
    "catalog_links": "SELECT cat_id, book, chapter_num, unnest(range(len(u)))::INTEGER AS at, unnest(u) AS link FROM (SELECT cat_id, book, chapter_num, list_filter(coalesce(CASE WHEN len(urls) > 0 THEN urls END, [url]), lambda x: x <> '') AS u FROM chapter_catalog)",
    "patch_titles": "SELECT t.tr_id, coalesce(s.title, t.title) AS title FROM translations t LEFT JOIN (SELECT book, id, last(title ORDER BY ord, row_id) AS title FROM segments WHERE title IS NOT NULL GROUP BY 1, 2) s ON t.book = s.book AND t.id = s.id",
    "title_similarity": f"SELECT page_id, round({similarity('listed', 'title')}, 6) AS similarity, {band(similarity('listed', 'title'))} AS band FROM ({COMPARED})",
    "similarity_bands": f"SELECT {band(similarity('listed', 'title'))} AS band, count(*) AS n_pages FROM ({COMPARED}) GROUP BY 1",
    "parsed_log": PARSED,
    "token_summary": f"""SELECT log_file, count(*) AS requests, count_if(id IS NOT NULL AND NOT starts_with(id, 'Title_'))::BIGINT AS content_requests, coalesce(sum(in_tokens), 0)::BIGINT AS in_tokens, coalesce(sum(out_tokens), 0)::BIGINT AS out_tokens, coalesce(sum(coalesce(in_tokens, 0) + coalesce(out_tokens, 0)), 0)::BIGINT AS total_tokens,
        round(avg(in_tokens), 4) AS avg_in, round(avg(out_tokens), 4) AS avg_out, count_if(status = 'ok')::BIGINT AS n_ok, count_if(status = 'failed')::BIGINT AS n_failed FROM ({PARSED}) GROUP BY log_file""",
    "crawl_summary": "SELECT site, sum(n)::BIGINT AS fetches, count(*) AS n_pages, sum(n - 1)::BIGINT AS retries, count_if(ok)::BIGINT AS n_ok, round(100.0 * count_if(ok) / count(*), 4)::DOUBLE AS success_rate FROM (SELECT site, url, count(*) AS n, max(coalesce(success, false)) AS ok FROM crawl_pages GROUP BY 1, 2) GROUP BY site",
    "status_by_type": "SELECT content_type, grouping(content_type) = 1 AS is_total, count(*) AS n_rows, count_if(status = 'success')::BIGINT AS n_success, count_if(status = 'skip')::BIGINT AS n_skip, count_if(status = 'error')::BIGINT AS n_error FROM (SELECT coalesce(content_type, 'none') AS content_type, CASE WHEN content IS NULL THEN 'error' WHEN trim(content) = '' THEN 'skip' ELSE 'success' END AS status FROM translations JOIN books USING (book)) GROUP BY ROLLUP (content_type)",
    "round_robin": "SELECT log_id, log_file, ((row_number() OVER (PARTITION BY log_file ORDER BY log_id) - 1) % 3)::INTEGER AS worker FROM request_log",
    "html_text": f"SELECT page_id, {strip(f'''coalesce(title, '')''')} AS title, array_to_string(list_filter(list_transform(regexp_split_to_array(x, '{LINE_END}'), lambda y: {strip('y')}), lambda y: y <> ''), {NL}) AS text FROM (SELECT page_id, title, {ENT.format(x=NOTAGS)} AS x FROM (SELECT page_id, title, {HTML} AS h FROM crawl_pages))",
    "stub_translate": f"SELECT row_id, '[stub] ' || {strip("coalesce(content, '')")} AS content, true AS ok, NULL::VARCHAR AS error, (length(coalesce(content, '')) + 2)::BIGINT AS in_tokens, (length({strip("coalesce(content, '')")}) + 7)::BIGINT AS out_tokens, 1::INTEGER AS attempts FROM segments",
    "title_map": f"SELECT book, chapter_key, replace(replace({strip("'[stub] ' || " + strip('title'))}, '\"', ''), '\\n', {NL}) AS title, true AS ok FROM (SELECT book, {R3} AS chapter_key, first(title ORDER BY ord, row_id) AS title FROM segments WHERE {R3} IS NOT NULL AND {strip("coalesce(title, '')")} <> '' GROUP BY 1, 2)",
    "run_progress": "SELECT log_id, log_file, round(100.0 * row_number() OVER (PARTITION BY log_file ORDER BY log_id) / count(*) OVER (PARTITION BY log_file), 4)::DOUBLE AS done_percent FROM request_log",
    "needs_processing": f"{PLAN} SELECT rel_path, mode, reason <> 'up to date' AS needed, reason FROM p",
    "missing_operations": f"{PLAN} SELECT rel_path, mode, reason FROM p WHERE reason <> 'up to date'",
    "operation_tree": f"{PLAN} SELECT string_split(rel_path, '/')[1] AS content_type, regexp_extract(rel_path, '^(.*)/[^/]*$', 1) AS folder, count(DISTINCT rel_path) AS files, count(*) AS operations, count_if(reason <> 'up to date')::BIGINT AS new_operations FROM p GROUP BY 1, 2",
}
CLEANED = f"SELECT tr_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(coalesce(content, ''), '(?s)<think>.*?(</think>[^\\n]*|$)', '', 'g'), {NL}), lambda x: {strip(f'''regexp_replace(x, '[{WS}]+', ' ', 'g')''')}), lambda x: x <> ''), {SEP}) AS clean FROM translations"
SQL["patch_failed"] = SQL["patch_failed"].replace("CLEANED", CLEANED)
