"""Splitting, packing and mixing: exact properties, hard rows, brute force."""

import os
import random
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkloom.llm import p1_split, p7_pack, p8_mix, queries, tokens
from inkloom.llm.scans import running, unit_hash


def n(text):
    return sum(c not in p1_split.WHITE_SPACE for c in text)


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 。，\n　.!́‍ 第\r")), max_size=400), st.integers(1, 60), st.integers(0, 30))
def test_pieces_rebuild_the_text_and_keep_the_limit(text, limit, overlap):
    pieces = p1_split.split_text(text, limit, overlap)
    assert "".join(core for _, core in pieces) == text
    before = ""
    for lead, core in pieces:
        assert n(lead + core) <= limit
        assert n(lead) <= overlap and before.endswith(lead)
        before += core


def test_cuts_fall_at_natural_boundaries():
    text = "一句话。" * 40 + "\n\n" + "另一句话。" * 40
    cores = [core for _, core in p1_split.split_text(text, 120, 20)]
    assert all(c.rstrip().endswith("。") for c in cores) and any(c.endswith("\n\n") for c in cores)
    long = "x" * 200_000
    assert all(n(a + b) <= 1500 for a, b in p1_split.split_text(long, 1500, 120))


def test_split_operator_on_hard_rows(spark):
    rows = [(1, "b", "Chapter_1_Segment_1", "t", "字" * 30, 9), (1, "b", "Chapter_1_Segment_1", "t", "字" * 30, 9), (2, "b", None, None, "字" * 10, 9), (3, "b", "x", "t", None, 9), (4, "none", "x", "t", "字" * 30, 9), (5, "c", "x", "t", "字" * 30, 9), (6, "b", " i ", "t", "字 " * 10, 9), (7, "b", "y", "t", "字​" * 6, 9)]
    seg = spark.createDataFrame(rows, "row_id long, book string, id string, title string, content string, max_chars int")
    books = spark.createDataFrame([("b", "m", 1), ("c", None, 1)], "book string, split_mode string, overlap_chars int")
    limits = spark.createDataFrame([("m", 10, 2)], "split_mode string, max_chars int, overlap_chars int")
    got = p1_split.split_oversized(seg, books, limits).collect()
    assert {r.row_id for r in got} == {1, 7} and all(r.n_chars <= 10 for r in got)
    assert sum(r.piece_id == "Chapter_1_Segment_1_Part_1" for r in got) == 2
    assert p1_split.split_oversized(seg.where("false"), books, limits).count() == 0


def test_found_matches_sql(spark, data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    want = sorted(r[0] for r in con.execute(queries.oracle_sql()["p1_found"]).fetchall())
    assert sorted(r.row_id for r in queries.p1_found(spark, data).collect()) == want


def best_count(sizes, capacity):
    """The fewest containers, by trying all."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in {x for x in rooms if x >= sizes[i]}:
            k = rooms.index(r)
            go(i + 1, rooms[:k] + [r - sizes[i]] + rooms[k + 1 :])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


def test_plan_uses_every_item_and_is_near_the_best():
    rnd = random.Random(2)
    more = 0
    for _ in range(150):
        cap = rnd.choice([10, 24, 50])
        sizes = [rnd.randint(1, cap) for _ in range(rnd.randint(0, 9))]
        plan = p7_pack.plan_containers(dict(Counter(sizes)), cap)
        used = Counter()
        for items, times in plan:
            assert sum(items) <= cap and times >= 1
            for s in items:
                used[s] += times
        assert used == Counter(sizes)
        more += sum(t for _, t in plan) - best_count(sizes, cap)
    assert more <= 4


def test_packing_operator(spark):
    sizes = [5, 10, 10, 3, 7, 0, None, 25, 1] + [4] * 50
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)] + [(0, 5, "x")], "doc_id long, n_tokens long, cap_name string")
    caps = spark.createDataFrame([("ten", 10), ("big", 100), ("bad", 0), ("null", None)], "cap_name string, capacity_tokens int")
    got = p7_pack.pack(df, caps).collect()
    for cap, room in (("ten", 10), ("big", 100)):
        own = [r for r in got if r.cap_name == cap]
        fill = Counter()
        for r in own:
            fill[r.container_id] += r.n_tokens
        assert max(fill.values()) <= room and set(fill) == set(range(len(fill)))
        assert sum(fill.values()) == sum(s or 0 for s in sizes) + 5
        assert {r.doc_id for r in own} == set(range(len(sizes)))
        parts = sorted((r.part_no, r.from_token, r.n_tokens) for r in own if r.doc_id == 7)
        assert parts == ([(1, 0, 10), (2, 10, 10), (3, 20, 5)] if cap == "ten" else [(1, 0, 25)])
    assert {r.cap_name for r in got} == {"ten", "big"}
    assert p7_pack.pack(df.where("false"), caps).count() == 0
    report = {r.cap_name: r for r in p7_pack.fill_report(p7_pack.pack(df, caps), caps).collect()}
    assert report["ten"].fullest == 10 and report["big"].unused >= 0


def test_running_sums(spark):
    df = spark.range(500).select("id", F.lit("g").alias("g"), unit_hash("id").alias("u"), (F.col("id") % 7).alias("v"))
    got = sorted(running(df, ["g"], "u", "v", "before", 8).collect(), key=lambda r: r.u)
    total = 0
    for r in got:
        assert r.before == total
        total += r.v


def test_mixing_meets_targets(spark):
    rows = [(i, "a", 10, 0) for i in range(400)] + [(1000 + i, "b", 20, 0) for i in range(40)] + [(5000, "c", 10, 0), (5001, None, 10, 0), (5002, "a", None, 0), (5003, "a", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, share int")
    goal = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3), ("gone", 0.0, 1)], "source string, target_share double, max_repeat int")
    got = p8_mix.mix(df, goal).collect()
    tok, uses = Counter(), Counter()
    for r in got:
        tok[r.source] += r.n_tokens
        uses[r.source, r.doc_id] += 1
    assert abs(tok["a"] / sum(tok.values()) - 0.5) < 0.01 and set(tok) == {"a", "b"}
    assert max(v for (s, _), v in uses.items() if s == "b") <= 3 and max(v for (s, _), v in uses.items() if s == "a") == 1
    assert sum(tok.values()) <= 4800
    # a copy only after the whole source went once
    assert {i for s, i in uses if s == "b"} == set(range(1000, 1040))
    small = p8_mix.mix(df, goal, budget=1000).collect()
    assert sum(r.n_tokens for r in small) <= 1000 and abs(sum(r.n_tokens for r in small if r.source == "a") - 500) <= 20
    order = [r.finish for r in p8_mix.in_order(p8_mix.mix(df, goal)).collect()]
    assert order == sorted(order)
    rep = {r.source: r for r in p8_mix.share_report(p8_mix.mix(df, goal), goal).collect()}
    assert rep["gone"].tokens == 0 and abs(rep["a"].share - 0.5) < 0.01
    assert p8_mix.mix(df.where("false"), goal).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, name):
    if not os.path.exists(f"{tokens.DEFAULT_FOLDER}/{name}"):
        pytest.skip("no tokenizers")
    df = spark.createDataFrame([(1, "Hello <|endoftext|> 第一章"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, "text", ["doc_id"], name=name).collect()}
    assert got[1] > 4 and got[2] == got[3] == 0
