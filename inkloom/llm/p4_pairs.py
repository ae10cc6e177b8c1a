"""Defective responses: empty, refused, copied, in another language, cut off."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.p2_truncated import features, judged
from inkloom.runtime import materialize, spread

# Words that are frequent in a language and hardly occur in the others.
STOPWORDS = {
    "en": "the of and to in was that he she it his her with for had not but at on from by is were as they said been have this an would did no into before up left until who",
    "vi": "và của là đã không một người trong có được cho với này những nhưng vào ra lại đến ở từ thì rồi bị như còn trên đều chưa mới nói lên đi hắn nàng chương",
    "fr": "le la les des et est une dans que qui pas pour sur avec elle il était au aux du ne ce son sa ses plus mais leur",
    "de": "der die das und ist nicht ein eine mit sich auf dem den von zu war er sie es im für auch als noch nach wie aber",
    "es": "el los las una que y en por con para su no se del como pero más era fue estaba ella él sus al lo",
    "id": "yang dan di itu dengan untuk tidak ini dari dia pada akan ke adalah telah sudah mereka ada tak dalam oleh bisa lalu",
    "pt": "o os as uma que e em por com para não se do da como mas mais era foi ela ele seu sua ao um",
    "it": "il lo gli una che e di in per con non si del della come ma più era fu lei lui suo sua al un nel",
}
SCRIPTS = (("ja", r"[぀-ヿ]"), ("ko", r"[가-힣]"), ("ru", r"[Ѐ-ӿ]"), ("th", r"[฀-๿]"), ("ar", r"[؀-ۿ]"), ("zh", r"[一-鿿]"))
VIETNAMESE = regex.compile(r"[ăđơưạảấầẩẫậắằẳẵặẹẻẽềếểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ]", regex.IGNORECASE)

# Wordings of a refusal, and what it refuses; a refusal holds one of each.
DECLINES = {
    "en": "i can't|i cannot|i can not|i'm unable|i am unable|i'm not able|i am not able|i won't|i will not|i must decline|i have to decline|can't assist|cannot assist|unable to help|can't help with|i'm sorry, but|i apologize|as an ai|as a language model|unfortunately, i|sorry - i|blocked|not permitted|against policy|violates|refused|safety filter|content filter|prohibited",
    "vi": "tôi không thể|tôi xin từ chối|xin từ chối|tôi buộc phải dừng|tôi rất tiếc|rất tiếc, tôi|xin lỗi, tôi|xin lỗi, nội dung|thành thật xin lỗi|không được phép|vi phạm|từ chối|bị chặn|không thể hỗ trợ|không thể dịch|mô hình ngôn ngữ|với tư cách là|bộ lọc|tôi không được",
    "zh": "我无法|无法翻译|无法提供|无法继续|无法协助|我不能翻译|不能继续翻译|不能提供|抱歉，我|很抱歉|对不起，我无法|作为人工智能|作为一个人工智能|作为ai|作为一个ai|语言模型|违反|被拦截|已拦截|拒绝翻译|拒绝提供|内容政策|安全策略|敏感内容|不符合规定|被屏蔽",
}
MATTERS = {
    "en": "translat|request|passage|content|material|policy|policies|chapter|language model|assist with|text|this kind|guideline|prohibited|safety|blocked",
    "vi": "dịch|yêu cầu|nội dung|chính sách|đoạn văn|chương khác|mô hình ngôn ngữ|hỗ trợ|văn bản|tài liệu|nhạy cảm|quy định|an toàn",
    "zh": "翻译|请求|内容|政策|段落|章节|文本|协助|语言模型|人工智能|规定|策略|原文|译文",
}
# What stands in place of a text.
PLACEHOLDERS = {"null", "none", "nil", "n/a", "na", "nan", "undefined", "todo", "tbd", "empty", "blank", "placeholder", "pending", "content", "title", "text", "translation", "translation here", "no content", "no title", "untitled", "无", "空", "暂无", "待翻译", "未翻译", "无内容", "无标题", "trống", "không có", "chưa dịch", "đang cập nhật", "nội dung", "tiêu đề", "bản dịch", "xxx", "lorem ipsum"}
HEADING = regex.compile(r"^[\s'#*_>\"“(\[【-]*(?:第\s*[0-9０-９零〇一二两三四五六七八九十百千]+\s*[章回话節节卷]|(?:chapter|chap\.?|chương|volume|vol\.|quyển|segment)\s*\d+)[^\n]{0,120}$", regex.IGNORECASE)
THOUGHT = regex.compile(r"<(think|thinking|thought|reasoning)>.*?(?:</\1>|$)", regex.IGNORECASE | regex.DOTALL)
FENCE = regex.compile(r"^\s*(?:`{3,}\w*|~{3,}|[-*_=#>.…·•—]{1,}|<[^<>]{1,40}>|\[\s*\])\s*$")
WORD = regex.compile(r"[\p{Han}]|[^\W_]+", regex.V0)
AFTER = 5  # sound lines after a refusal, at most
QUOTED = regex.compile(r"[“\"「『][^”\"」』]*(?:[”\"」』]|$)")


@lru_cache(maxsize=1)
def refusals():
    """Automata of the wordings and of the matters, over all languages."""
    out = []
    for lists in (DECLINES, MATTERS):
        a = ahocorasick.Automaton()
        for phrases in lists.values():
            for p in phrases.split("|"):
                a.add_word(p, p)
        a.make_automaton()
        out.append(a)
    return out


def refuses(line: str) -> bool:
    """Whether a line declines the task, outside what characters say in quotation marks."""
    t = QUOTED.sub(" ", line).replace("’", "'").lower()
    if len(t.strip()) < 4:
        return False
    decline, matter = refusals()
    spans = [(i - len(p) + 1, i) for i, p in decline.iter(t)]
    if not spans:
        return False
    # a matter inside the wording itself doesn't count twice, but for those that name the model or a rule
    return any(True for _ in matter.iter(t))


def refused(lines: list[str]) -> bool:
    """Whether a response declines instead of translating: of all its lines one refuses, and hardly any that doesn't comes after it."""
    hits = [i for i, x in enumerate(lines) if refuses(x)]
    return bool(hits) and len(lines) - hits[0] - len(hits) <= AFTER


# Delimiters and what closes them.
CLOSED_BY = {"“": "”", "「": "」", "『": "』", "（": "）", "(": ")", "《": "》", "【": "】", "[": "]", "〈": "〉"}
OPENED_BY = {b: a for a, b in CLOSED_BY.items()}
DELIMITER = regex.compile("[" + "".join(regex.escape(c) for c in (*CLOSED_BY, *OPENED_BY)) + '"]|\\n|`{3,}')


def left_open(text: str) -> list[str]:
    """The delimiters of a text that are still open at its end.

    A closing one also closes what was opened inside it. A quotation mark that
    opens a paragraph inside an open quotation continues it. A straight mark
    opens and closes within its paragraph; a fence closes the one before.
    """
    stack: list[str] = []
    at = 0  # where the paragraph begins
    for m in DELIMITER.finditer(text):
        c = m.group()
        if c == "\n":
            at = m.end()
            if '"' in stack:
                stack.remove('"')
        elif c[0] == "`" or c == '"':
            mark = '"' if c == '"' else "```"
            if mark in stack:
                del stack[stack.index(mark) :]
            else:
                stack.append(mark)
        elif c in CLOSED_BY:
            if not (stack and stack[-1] == c == "“" and not text[at : m.start()].strip()):
                stack.append(c)
        elif OPENED_BY[c] in stack:
            while stack.pop() != OPENED_BY[c]:
                pass
    return stack


@lru_cache(maxsize=1)
def _voters():
    words: dict[str, list[str]] = {}
    for lang, ws in STOPWORDS.items():
        for w in ws.split():
            words.setdefault(w, []).append(lang)
    return words, [(lang, regex.compile(p)) for lang, p in SCRIPTS]


def language(line: str) -> str | None:
    """A line's language by script, letters and stopword votes; None when it says nothing."""
    words, scripts = _voters()
    letters = sum(c.isalpha() for c in line)
    if not letters:
        return None
    if not line.isascii():
        for lang, p in scripts:
            n = len(p.findall(line))
            if n and n * (3 if lang in ("zh", "ja", "ko") else 2) >= letters:
                return lang
    if len(VIETNAMESE.findall(line)) * 12 >= letters:
        return "vi"
    votes: Counter = Counter()
    for w in regex.findall(r"[^\W\d_]+", line.lower()):
        for lang in words.get(w, ()):
            votes[lang] += 1
    if not votes:
        return None
    top = votes.most_common(2)
    return top[0][0] if len(top) == 1 or top[0][1] > top[1][1] else None


class SuffixAutomaton:
    """All factors of a token sequence; built and traversed in linear time."""

    def __init__(self, seq: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in seq:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def covered(self, seq: list[str], least: int) -> int:
        """Tokens of ``seq`` inside factors of at least ``least`` tokens (or of all of it)."""
        least = min(least, len(seq))
        state = n = 0
        mark = [False] * len(seq)
        for i, c in enumerate(seq):
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            else:
                state = n = 0
            if n >= least:
                for k in range(i, i - n, -1):
                    if mark[k]:
                        break
                    mark[k] = True
        return sum(mark)


def clean(text: str | None) -> str:
    """A response without thinking blocks and with its line breaks unescaped."""
    if not text:
        return ""
    if "\\n" in text:
        text = text.replace("\\r", "").replace("\\n", "\n")
    if "<" in text:
        text = THOUGHT.sub("", text)
    return text.replace("​", "").replace("﻿", "")


def own_lines(text: str) -> list[str]:
    """The non-blank lines of a cleaned response without its heading and formatting marks."""
    lines = [x.strip() for x in text.splitlines()]
    return [x for x in lines if x and not FENCE.match(x) and not HEADING.match(x)]


def is_placeholder(text: str) -> bool:
    t = text.strip().strip("'\"`[](){}<>【】（）“”*_#.。…-—:： ").lower()
    return t in PLACEHOLDERS or not any(c.isalnum() for c in t)


def copied_lines(lines: list[str], source: str, langs: list[str | None], from_lang: str | None) -> int:
    """How many of the lines are the source text, by the coverage of its suffix automaton."""
    may = [x for x, lang in zip(lines, langs) if lang is None or lang == from_lang or from_lang is None]
    if 2 * len(may) <= len(lines) or not source:
        return 0
    automaton = SuffixAutomaton(WORD.findall(source.lower()))
    n = 0
    for x in may:
        seq = WORD.findall(x.lower())
        n += bool(seq) and automaton.covered(seq, 6) >= 0.8 * len(seq)
    return n


def copied_title(title: str, source: str) -> bool:
    """Whether the automaton of the source title covers all of a title that is about as long."""
    a, b = (WORD.findall(x.lower()) for x in (title, source))
    return bool(a) and 10 * len(a) >= 9 * len(b) and SuffixAutomaton(b).covered(a, len(a)) == len(a)


def defect(field: str, text: str | None, source: str | None, target: str | None) -> str | None:
    """The defect of a field, but for text cut off outside any delimiters, which needs the corpus."""
    t = clean(text)
    if not t.strip() or is_placeholder(t):
        return "empty"
    if field == "title":
        lines = [x.strip() for x in t.splitlines() if x.strip()]
    else:
        lines = own_lines(t)
        if not lines or all(is_placeholder(x) for x in lines):
            return "empty"
    if refused(lines):
        return "refusal"
    source = clean(source)
    langs = [language(x) for x in lines]
    votes = Counter(x for x in map(language, [y for y in source.splitlines() if y.strip()]) if x)
    from_lang = votes.most_common(1)[0][0] if votes else None
    if source and not (from_lang and from_lang == target):
        if field == "title":
            if copied_title(t, source) and not (target in ("vi", "en") and from_lang is None and HEADING.match(source) is None):
                return "copied"
        elif 2 * copied_lines(lines, source, langs, from_lang) > len(lines):
            return "copied"
    if target:
        wrong = sum(x is not None and x not in (target, from_lang) for x in langs)
        if 2 * wrong > len(langs):
            return "wrong_language"
    return "truncated" if field == "content" and left_open(t) else None


def sources_of(segments: DataFrame) -> DataFrame:
    """book, key, source_title, source_content: one row for each (book, id), its case and blanks aside."""
    key = F.lower(F.regexp_replace("id", r"\s+", ""))
    return segments.where("id is not null").groupBy("book", key.alias("key")).agg(F.max_by("title", F.struct(F.length(F.coalesce("title", F.lit(""))), F.col("row_id"))).alias("source_title"), F.max_by("content", F.struct(F.length(F.coalesce("content", F.lit(""))), F.col("row_id"))).alias("source_content"))


def defects(translations: DataFrame, segments: DataFrame) -> DataFrame:
    """tr_id, field_name, defect of each defective field of ``translations``.

    A field has one defect at most, the first of empty, refusal, copied,
    wrong_language, truncated. A row without a source is judged alone. A null
    target language gives no wrong_language. Repeated rows are judged alike.
    """
    ids = translations.select("book", F.lower(F.regexp_replace("id", r"\s+", "")).alias("key")).distinct()
    needed = segments.select("row_id", "book", "id", "title", "content").withColumn("key", F.lower(F.regexp_replace("id", r"\s+", ""))).join(ids, ["book", "key"], "left_semi").drop("key")
    rows = translations.select("tr_id", "book", F.lower(F.regexp_replace("id", r"\s+", "")).alias("key"), "title", "content", "target_lang").join(sources_of(needed), ["book", "key"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, names, found = [], [], []
            for r in (x for at in range(0, b.num_rows, 256) for x in b.slice(at, 256).to_pylist()):
                for f in ("title", "content"):
                    d = defect(f, r[f], r[f"source_{f}"], r["target_lang"])
                    if d:
                        ids.append(r["tr_id"])
                        names.append(f)
                        found.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(found, pa.string())], names=["tr_id", "field_name", "defect"])

    first = materialize(spread(rows.select("tr_id", "title", "content", "target_lang", "source_title", "source_content"), read=translations).mapInArrow(run, "tr_id long, field_name string, defect string"), "defects")
    text = F.regexp_replace(F.regexp_replace("content", r"(?is)<(think|thinking)>.*?</\1>", ""), r"\\n", "\n")
    feats = materialize(features(translations.where("content is not null").select("tr_id", text.alias("content"), F.col("provider")), "tr_id", "content", "provider"), "responses")
    cut = judged(feats).where("cut").select(F.col("row_id").alias("tr_id"), F.lit("content").alias("field_name"), F.lit("truncated").alias("defect"))
    return first.unionByName(cut.join(first.where("field_name = 'content'").select("tr_id"), "tr_id", "left_anti"))
