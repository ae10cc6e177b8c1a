"""Cut-off texts, responses, encodings, pages, alignment and subjects on small cases with known answers."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkloom.llm import grams, p2_truncated as p2, p3_wrapper as p3, p4_pairs as p4, p5_encoding as p5, p6_align as p6, p9_subjects as p9

RND = random.Random(9)
WORDS = "river lantern winter garden letter harbour window silver candle mountain bridge market".split()


def sentence():
    return "The " + " ".join(RND.choice(WORDS) for _ in range(RND.randint(5, 9))) + " was quiet."


def story(k):
    return "\n\n".join(" ".join(sentence() for _ in range(3)) for _ in range(k))


# p2


@pytest.mark.parametrize("text, how", [("A b.", p2.COMPLETE), ("他说。”", p2.COMPLETE), ("他喊：“走！”", p2.OPEN), ("“走！快走！”", p2.COMPLETE), ("he wen", p2.OPEN), ("the end...", p2.ELLIPSIS), ("x &nbs", p2.CUT), ("x \\u4e", p2.CUT), ("x<p class=\"t", p2.CUT), ("“别碰", p2.CUT), ("x [...]", p2.CUT), ("x …[+97 chars]", p2.CUT), ("x�", p2.CUT), ("", p2.COMPLETE), (" 　\n", p2.COMPLETE), ("x... (read more)", p2.CUT)])
def test_endings(text, how):
    assert p2.ending(text) == how


def test_cut_rows_are_found(spark):
    rows, cut = [], set()
    for i in range(400):
        t = story(3)
        kind = i % 8
        if kind == 0:
            t, _ = t[: len(t) - RND.randint(3, 30)].rstrip(" .\n"), cut.add(i)
        elif kind == 1:
            t += "\n\n(end of chapter)"
        elif kind == 2:
            t += "\n\nSnow on the old stone steps\nOne lamp to guide us home"
        rows.append((i, t, "s" if i % 2 else None, 1))
    rows += [(1000, None, "s", 1), (1001, "", "s", 1), (1002, rows[0][1], "s", 1), (1003, story(400), "s", 1)]
    cut.add(1002)
    df = spark.createDataFrame(rows, "row_id long, content string, source string, chunk int")
    got = p2.truncated(df)
    found = {r.row_id for r in got.where("cut").collect()}
    assert len(found & cut) >= 0.95 * len(cut) and len(found - cut) <= 2
    rates = {r.source: r.n_rows for r in p2.rates(got).collect()}
    assert sum(rates.values()) == len(rows) - 1
    assert p2.truncated(df.where("false")).count() == 0


def test_a_copy_that_ends_early(spark):
    whole = story(12)
    early = whole[: int(len(whole) * 0.93)]
    early = early[: early.rindex(" ")] + "..."
    df = spark.createDataFrame([(1, whole, "s"), (2, early, "s"), (3, story(12), "s"), (4, whole, "s")], "row_id long, content string, source string")
    feats = p2.materialize(p2.features(df, "row_id", "content", "source"), "t")
    assert {r.row_id for r in p2.copies_that_go_on(feats, df, "row_id", "content").collect()} == {2}
    assert p2.ends_early(early, whole) and not p2.ends_early(whole, early) and not p2.ends_early(story(12), whole)


def test_minhash_bands_find_near_copies():
    texts = [story(8) for _ in range(60)]
    near = [t[: int(len(t) * 0.95)] for t in texts]
    t = grams.tokens(texts + near)
    word = t.kind != grams.MARK
    s, d = grams.shingles(t.hash[word], t.doc[word], 5)
    b = grams.bands(s, d, 120, p2.BANDS, p2.ROWS)
    assert np.mean([(b[i] == b[60 + i]).any() for i in range(60)]) >= 0.95


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_tokens_stay_in_their_text(texts):
    t = grams.tokens([x.replace("\n", " ") for x in texts])
    starts = np.cumsum([0] + [len(x) + 1 for x in texts])
    assert all(starts[d] <= a < b <= starts[d + 1] for d, a, b in zip(t.doc, t.start, t.end))


def test_words_of_any_length_and_plane():
    a, b = "x" * 70 + "ab" + "y" * 10, "x" * 70 + "ba" + "y" * 10
    t = grams.tokens([a, b, a, "\U00010414\U00010415 \U00020001"])  # letters and a Han character beyond the first plane
    assert len(set(t.hash[:3].tolist())) == 2 and t.hash[0] == t.hash[2]
    assert t.kind.tolist() == [grams.LETTER] * 4 + [grams.HAN]


# p5


@pytest.mark.parametrize("text, stored, read", [("第1章 墨池谷夜雨", "utf-8", "latin-1"), ("“Wait,” he said — and left", "utf-8", "cp1252"), ("“Wait,” he said", "utf-8", "cp437"), ("Chương 3: Lần đầu đến tháp", "utf-8", "latin-1"), ("铁面具的秘密，谁拿走了", "gb2312", "latin-1"), ("铁面具的秘密谁拿走了", "gb2312", "big5"), ("“Đừng chạm vào”", "utf-8", "koi8-r"), ("Trang chủ Kho truyện", "utf-8", "iso8859-2")])
def test_garbled_text_is_restored(text, stored, read):
    bad = "".join(bytes([b]).decode(read) if read in p5.READ_ONE_BYTE and (lambda x: True)(b) and _can(b, read) else chr(b) for b in text.encode(stored)) if read in p5.READ_ONE_BYTE else text.encode(stored).decode(read, "replace")
    fixed, garbled = p5.repair_line(bad)
    assert garbled
    if "�" not in bad:
        assert fixed == text


def _can(b, read):
    try:
        bytes([b]).decode(read)
        return True
    except UnicodeDecodeError:
        return False


@pytest.mark.parametrize("text", ["The sign said “Café Zéphyrîne”, £103 the cup.", "他推開客棧的門，看見院子裡站著一個人。", "墙上是西里尔字母：Ворота закрыты。", "The gate bore the words Ворота закрыты and 门已关.", "温度计停在 −12 °C，½ 的水已经结冰 ≈ 145 升。", "Ærwyn à Châtelör, §12 ¶3 — naïve, Éloïse", "宿泠戟发来一个表情：(´・ω・`)？", "Đêm hôm ấy, Văn Linh Hành", "门牌写着“ﾐｽﾞﾉﾄ屋”", "本站使用Cookie来改善您的浏览体验", ""])
def test_unusual_but_intended_text_stays(text):
    assert p5.repair_line(text) == (text, False)


def test_mixed_text_is_touched_where_garbled(spark):
    ok, bad = "他说：Café 好", "“早”"
    df = spark.createDataFrame([(1, ok + " " + bad.encode().decode("latin-1"), "x", "y"), (2, None, None, "y"), (3, "", "a�", "y")], "page_id long, title string, content string, original string")
    got = {(r.page_id, r.field_name): (r.original, r.complete) for r in p5.repair_fields(df, "page_id").collect()}
    assert got == {(1, "title"): (ok + " " + bad, True), (3, "content"): ("a�", False)}
    assert p5.repair_fields(df.where("false"), "page_id").count() == 0


@pytest.mark.parametrize("stored", [p5.STORED_UTF8, p5.STORED_GB, p5.STORED_BIG5])
@pytest.mark.parametrize("read", p5.READ_ONE_BYTE)
def test_every_pair_of_encodings(stored, read):
    text = "他推开客栈的门，看见院子里站着一个人。" if stored == p5.STORED_GB else "他推開客棧的門，看見院子裡站著一個人。" if stored == p5.STORED_BIG5 else "“Chương này,” hắn nói, “ta sẽ trở lại…”"
    bad = "".join(p5.characters(read)[b] for b in text.encode(stored))
    assert p5.repair_line(bad) == (text, True)


def test_garbled_spans_in_sound_lines():
    bad = "客栈老板".encode("gb2312").decode("latin-1")
    line = "他推开门，看见院子里站着一个人，手里提着灯笼，说：" + bad + "，请进。"
    assert p5.repair_line(line) == (line.replace(bad, "客栈老板"), True)
    russian = "墙上是西里尔字母：Ворота закрыты。"
    assert p5.repair_line("".join(p5.characters("cp1252")[b] for b in russian.encode("gb2312"))) == (russian, True)


def test_vietnamese_font_code():
    back = {v: k for k, v in p5.vni_table().items() if len(k) == 2 or k in "ñöôæóòî"}
    text = "ai đã lấy chén trà sứ"
    assert p5.repair_line("".join(back.get(c, c) for c in text)) == (text, True)


# p3


def page(k, title=True):
    head = ["Home", "Library", f"Home > Fantasy > Book {RND.choice(WORDS)}"] + (["We use cookies to improve reading."] if k % 2 else [])
    body = ([f"Chapter {k}: The {RND.choice(WORDS)}"] if title else []) + [sentence() for _ in range(RND.randint(3, 9))]
    if k % 3 == 0:
        body.insert(2, "Bookmark slow.test now!")
    tail = ["More in this genre", f"{k}. The {RND.choice(WORDS)}", f"The {RND.choice(WORDS)}", f"Write to help@slow.test", f"© 20{k % 20 + 10} Slow. All rights reserved."]
    own = [x in body and "slow.test" not in x for x in head + body + tail]
    return head + body + tail, own


def test_wrappers_separate_the_body(spark):
    rows, want = [], {}
    for k in range(1, 121):
        lines, own = page(k)
        rows.append((k, "slow.test", f"Chapter {k}: X" + (" | Slow" if k % 2 else ""), "\n".join(lines), 1))
        want[k] = own
    rows += [(500, "slow.test", None, None, 1), (501, None, "", "", 1), (502, "slow.test", "x", "Home\nLibrary\nWrite to help@slow.test\n", 1), (1, "slow.test", "Chapter 1: X | Slow", rows[0][3], 1)]
    df = spark.createDataFrame(rows, "page_id long, site string, title string, content string, frame int")
    got = p3.main_bodies(df)
    mine = {r.page_id: list(r.own) for r in got.collect()}
    wrong = sum(a != b for k, own in want.items() for a, b in zip(mine[k], own))
    assert wrong <= 0.01 * sum(map(len, want.values()))
    assert mine[500] == [] and not any(mine[502])
    lines = {(r.page_id, r.line_no) for r in p3.boilerplate_lines(got).collect()}
    assert (1, 0) in lines and (2, 0) not in lines and (502, 4) not in lines and (502, 1) in lines
    assert p3.main_bodies(df.where("false")).count() == 0


def test_wrappers_of_many_hosts_and_parts(spark, monkeypatch):
    """The same lines whether hosts are broadcast or joined in salted parts, and wrappers merged at once or as a tree."""
    rows = [(k, f"h{k % 2}.test", f"Chapter {k}: X", "\n".join(page(k)[0])) for k in range(1, 121)]
    df = spark.createDataFrame(rows, "page_id long, site string, title string, content string")
    want = {tuple(r) for r in p3.boilerplate_lines(p3.main_bodies(df)).collect()}
    monkeypatch.setattr(p3, "HOSTS", 0)
    assert {tuple(r) for r in p3.boilerplate_lines(p3.main_bodies(df)).collect()} == want
    stream = p3.materialize(p3.streams(df), "s")
    frame = p3.materialize(p3.frames(stream), "f")
    pick = lambda w: {r.site: set(r.token) for r in w.collect()}
    assert pick(p3.wrappers(stream, frame, each=3)) == pick(p3.wrappers(stream, frame))


def test_wrapper_inference():
    w = p3.infer([(["a", p3.BODY, "x"], 5), (["a", "b", p3.BODY, "x"], 3), (["b", p3.BODY, "y", "x"], 1)])
    assert [s for s, _ in w] == ["a", "b", p3.BODY, "y", "x"] and dict(map(tuple, w))[p3.BODY] == 9
    r = p3.roles(w)
    assert r["a"][0] == 8 and r["x"][2] == 9


@pytest.mark.parametrize("title, head, extra", [("第1章 石砚的秘密", "第1章 石砚的秘密", False), (" 第1章 A \n", "第1章 A", False), ("第1章 A | Site", "第1章 A", True), ("Book 第2章 A", "第2章 A", True), ("Chapter 1: A_B_Site", "Chapter 1: A", True), ("Chương 1 - Lời hẹn", "Chương 1 - Lời hẹn", False), ("Chương 1: Lời hẹn（đọc online）", "Chương 1: Lời hẹn", True)])
def test_titles(title, head, extra):
    assert p3.title_parts(title) == (head, extra)


# p4

ZH = "灯灭的一瞬间，他把信烧成了灰。\n\n码头的雨一直没有停。\n\n他数着日子等春天来。"
VI = "Khoảnh khắc đèn tắt, hắn đốt lá thư thành tro.\n\nMưa ở bến tàu mãi vẫn không ngừng.\n\nHắn đếm từng ngày chờ mùa xuân."
EN = "The moment the lamp died, he burned the letter to ash.\n\nThe rain over the wharf would not let up.\n\nHe counted the days until spring."


@pytest.mark.parametrize("text, want", [(None, "empty"), ("", "empty"), ("null", "empty"), ("```\n\n```", "empty"), ("<think>\nx\n</think>\n", "empty"), ("'Chương 1: A", "empty"), ("Xin lỗi, tôi không thể hỗ trợ yêu cầu này.", "refusal"), ("As an AI language model, I am unable to help with this request.", "refusal"), ("抱歉，我无法翻译这段内容。", "refusal"), ("[content blocked by the provider]", "refusal"), (ZH, "copied"), ("> " + ZH.replace("。", "").replace("\n\n", "\n> "), "copied"), (EN, "wrong_language"), (VI, None), ("“Xin lỗi, ta không giúp được ngươi,” hắn nói.\n\n" + VI, None), (VI + "\n\n" + ZH.split("\n")[0], None)])
def test_defects(text, want):
    assert p4.defect("content", text, ZH, "vi") == want


def test_title_defects():
    assert p4.defect("title", "第1章 夜雨", "'第1章  夜雨", "vi") == "copied"
    assert p4.defect("title", "Chapter 1: The Night", "第1章 夜雨", "vi") == "wrong_language"
    assert p4.defect("title", "Chương 1: Mưa đêm", "第1章 夜雨", "vi") is None
    assert p4.defect("title", "  ", None, None) == "empty"


@pytest.mark.parametrize("text, left", [("a “b” c", []), ("a “b\n\n“c” d", []), ("a “b「c」", ["“"]), ("(a [b) c", []), ("“a\n\nb. c.", ["“"]), ('he said "x.', ['"']), ('he said "x\n\ny.', []), ("```\na\n```", []), ("```\na.", ["```"]), ("a) b”", []), ("", [])])
def test_delimiters_left_open(text, left):
    assert p4.left_open(text) == left


def test_a_stop_inside_open_delimiters_is_cut():
    assert p4.defect("content", VI + "\n\n“Ta đã đi.\n\nHắn dừng lại.", ZH, "vi") == "truncated"
    assert p4.defect("content", VI + "\n\n“Ta đã đi.”", ZH, "vi") is None


def test_refusals_anywhere():
    no = "Xin lỗi, tôi không thể hỗ trợ yêu cầu này."
    assert p4.defect("content", "\n\n".join([VI] * 4 + [no]), ZH, "vi") == "refusal"  # the last line of many
    assert p4.defect("content", "\n\n".join([VI] * 4 + [no, "Mưa rơi."]), ZH, "vi") == "refusal"
    assert p4.defect("content", "\n\n".join([VI] * 4 + [no] + [VI] * 4), ZH, "vi") is None  # the translation goes on
    assert p4.copied_title("第1章 夜雨", "'第1章  夜雨") and not p4.copied_title("第1章", "第1章 夜雨") and not p4.copied_title("", "x")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=10), st.integers(1, 4))
def test_suffix_automaton_against_all_factors(source, seq, least):
    factors = {tuple(source[i:j]) for i in range(len(source)) for j in range(i, len(source) + 1)}
    k = min(least, len(seq))
    want = {p for i in range(len(seq)) for j in range(i + k, len(seq) + 1) if k and tuple(seq[i:j]) in factors for p in range(i, j)}
    assert p4.SuffixAutomaton(source).covered(seq, least) == len(want)


def test_defects_operator(spark):
    seg = spark.createDataFrame([(1, "b", "Chapter_1", "第1章 夜雨", ZH, 1), (2, "b", " chapter_1", None, None, 1)], "row_id long, book string, id string, title string, content string, key int")
    long = "\n\n".join([VI] * 30)
    rows = [(1, "b", "Chapter_1", "Chương 1: Mưa đêm", long, "vi", "p"), (2, "b", "Chapter_1", None, ZH, "vi", None), (3, "b", "nowhere", "Chương 2", long[:-12], "vi", "p"), (3, "b", "nowhere", "Chương 2", long[:-12], "vi", "p"), (4, None, None, "Chương 3: x", EN, None, "p")]
    rows += [(10 + i, "b", "Chapter_1", "Chương 1: Mưa đêm", long, "vi", "p") for i in range(5)]
    tr = spark.createDataFrame(rows, "tr_id long, book string, id string, title string, content string, target_lang string, provider string")
    got = sorted(map(tuple, p4.defects(tr, seg).collect()))
    assert got == [(2, "content", "copied"), (2, "title", "empty"), (3, "content", "truncated"), (3, "content", "truncated")]
    assert p4.defects(tr.where("false"), seg.where("false")).count() == 0


# p6

LEX = {"river": "riviere", "lantern": "lanterne", "winter": "hiver", "garden": "jardin", "letter": "lettre", "harbour": "port", "window": "fenetre", "silver": "argent", "candle": "bougie", "mountain": "montagne", "bridge": "pont", "market": "marche"}


def test_alignment_finds_pairs(spark):
    rnd = random.Random(3)
    rows, want = [], set()
    for c in range(150):
        a, b, links = [], [], []
        for _ in range(rnd.randint(5, 10)):
            ws = rnd.sample(WORDS, 5)
            x, y = f"The {' '.join(ws)} and the {rnd.randint(1, 400)} ships.", "Le " + " ".join(LEX[w] for w in reversed(ws)) + " avec les bateaux."
            kind = rnd.random()
            if kind < 0.08:
                a.append(x)
                continue
            if kind < 0.16 and a and links and links[-1][0] == len(a):
                b[-1] = b[-1] + " " + y
                a.append(x)
                links.append((len(a), len(b)))
                continue
            a.append(x)
            b.append(y)
            links.append((len(a), len(b)))
        rows += [(2 * c, "b", f"c{c}", "en", "\n\n".join(a), 1), (2 * c + 1, "b", f"c{c}", "fr" if c % 3 else None, "\n".join(b), 1)]
        want |= {(2 * c, i, 2 * c + 1, j) for i, j in links}
    rows += [(9001, "b", "alone", "en", "x", 1), (9002, "b", "n", "en", None, 1), (9003, "b", "n", "fr", "Le pont.", 1), (9004, None, None, "fr", "Le pont.", 1)]
    df = spark.createDataFrame(rows, "bil_id long, book string, id string, lang string, content string, pair int")
    got = {tuple(r) for r in p6.align(df).collect()}
    assert len(got & want) >= 0.93 * len(want) and len(got & want) >= 0.93 * len(got)
    assert p6.align(df.where("false")).count() == 0


def test_more_than_two_rows_and_long_chapters(spark, monkeypatch):
    """Each of three rows is paired with each in another language; a chapter in tiles gives the same links."""
    rnd = random.Random(5)
    rows = []
    for c in range(80):
        ws = [rnd.sample(WORDS, 5) for _ in range(8)]
        en, fr = "\n".join("The " + " ".join(w) for w in ws), "\n".join("Le " + " ".join(LEX[x] for x in w) for w in ws)
        rows += [(3 * c, "b", f"c{c}", "en", en), (3 * c + 1, "b", f"c{c}", "fr", fr), (3 * c + 2, "b", f"c{c}", "fr", fr)]
    df = spark.createDataFrame(rows, "bil_id long, book string, id string, lang string, content string")
    got = {tuple(r) for r in p6.align(df).collect()}
    want = {(3 * c, i, 3 * c + k, i) for c in range(80) for i in range(1, 9) for k in (1, 2)}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)
    chapter = p6.materialize(p6.chapters(df, 2), "c").toPandas()
    model = p6.build_model(p6.train(spark.createDataFrame(chapter), 2)["en-fr"])
    flat = lambda x: (np.concatenate(x), np.array([len(y) for y in x]))
    first = chapter.iloc[0]
    whole = p6.link(model, flat(first.words_a), flat(first.words_b))
    monkeypatch.setattr(p6, "TILE", 3)
    assert p6.link(model, flat(first.words_a), flat(first.words_b)) == whole and len(whole) >= 7


@pytest.mark.parametrize("s, v", [("三百四十二", 342), ("十", 10), ("一百零五", 105), ("两千", 2000), ("一万二千", 12000)])
def test_han_numbers(s, v):
    assert p6.han_number(s) == v


# p9

TOPICS = {"law": "court verdict witness judge appeal".split(), "music": "melody chorus violin rhythm drum".split(), "sport": "goal referee sprint match coach".split()}


def doc(topics):
    lines = [sentence() for _ in range(8)]
    for t in topics:
        lines += [f"The {RND.choice(TOPICS[t])} and the {RND.choice(TOPICS[t])} went on." for _ in range(4)]
    if RND.random() < 0.3:
        lines.append(f"Once the {RND.choice(TOPICS[RND.choice(list(TOPICS))])} passed by.")
    RND.shuffle(lines)
    return " ".join(lines)


def test_subjects(spark):
    truth = [RND.choice([[], ["law"], ["music"], ["sport"], ["law", "music"]]) for _ in range(500)]
    docs = [(i, doc(t), "s", "x") for i, t in enumerate(truth)]
    labels = [(i, s.upper() if i % 5 == 0 else f" {s}") for i, t in enumerate(truth[:350]) for s in t if i % 17]
    d = spark.createDataFrame(docs + [(900, None, "s", "x"), (901, "", "s", "x"), (0, docs[0][1], "s", "x")], "doc_id long, text string, source string, subject string")
    lab = spark.createDataFrame(labels + [(3, None), (None, "law")], "doc_id long, subject string")
    subs = spark.createDataFrame([("law",), ("music",), ("sport",)], "subject string")
    got = p9.subjects_of(d, lab, subs).collect()
    mine = {(r.doc_id, r.subject) for r in got}
    want = {(i, s) for i, t in enumerate(truth) for s in t}
    held = lambda x: {p for p in x if p[0] >= 350}
    assert len(held(mine) & held(want)) >= 0.9 * len(held(want)) and len(held(mine) & held(want)) >= 0.9 * len(held(mine))
    assert sum(r.doc_id == 0 for r in got) == 2 * len({s for i, s in mine if i == 0})
    assert p9.subjects_of(d.where("false"), lab, subs).count() == 0
    assert p9.subjects_of(d, lab.where("false"), subs).count() == 0


def test_each_subject_has_its_own_threshold():
    """One subject is told by one sentence, the other only by three: a common threshold would lose one of them."""
    rnd = random.Random(6)
    texts, labels = [], []
    for i in range(900):
        lines = [sentence() for _ in range(6)]
        kind = i % 3
        if kind == 0:
            lines.append(f"The {rnd.choice(TOPICS['law'])} and the {rnd.choice(TOPICS['law'])} went on.")
        n = 4 if kind == 1 else 1
        lines += [f"The {rnd.choice(TOPICS['music'])} and the {rnd.choice(TOPICS['music'])} went on." for _ in range(n)]
        rnd.shuffle(lines)
        texts.append(" ".join(lines))
        labels.append([["law"], ["music"], []][kind])
    m = p9.fit(texts, labels, ["law", "music"])
    assert m.least[0] < m.least[1] or m.cut[0] < m.cut[1]
    got = p9.predict(m, texts)
    assert sum(g == w for g, w in zip(got, labels)) >= 0.95 * len(texts)


def test_model_survives_packing():
    m = p9.fit([doc(["law"]) for _ in range(40)] + [doc(["music"]) for _ in range(40)], [["law"]] * 40 + [["music"]] * 40, ["law", "music"])
    x = p9.unpack(p9.pack(m))
    assert x.subjects == m.subjects and (x.known == m.known).all() and p9.predict(x, [doc(["law"]), "", doc(["music"])]) == [["law"], [], ["music"]]
