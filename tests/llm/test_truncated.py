"""Cut-off texts among many copies and near copies."""

import random

import pytest
from pyspark.sql import functions as F

from inkloom.llm import p2_truncated as p2

RND = random.Random(4)
WORDS = "river lantern winter garden letter harbour window silver candle mountain bridge market orchard hollow copper thunder meadow needle ribbon saddle temple valley walnut anchor barrel cellar dragon engine falcon ginger".split()


def sentence():
    return "The " + " ".join(RND.choice(WORDS) for _ in range(RND.randint(5, 9))) + " was quiet."


def story(k):
    return "\n\n".join(" ".join(sentence() for _ in range(3)) for _ in range(k))


def test_copies_of_a_cut_text_are_no_formula(spark):
    cut = story(3) + "\n\nThe gar"
    rows = [(i, story(3) + ("\n\n(end of chapter)" if i % 3 == 0 else ""), "s") for i in range(60)]
    rows += [(100 + i, cut, "s") for i in range(30)]
    df = spark.createDataFrame(rows, "row_id long, content string, source string")
    assert {r.row_id for r in p2.truncated(df).where("cut").collect()} == set(range(100, 130))


def in_one_band(spark, texts):
    df = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "row_id long, content string, source string")
    feats = p2.features(df, "row_id", "content", "source").withColumn("bands", F.when(F.col("chunk").isNull(), F.array(F.lit(7).cast("long"))))
    return p2.materialize(feats, "t"), df


@pytest.mark.parametrize("hot", [2, 10_000])
def test_every_longer_copy_of_a_band_is_tried(spark, monkeypatch, hot):
    monkeypatch.setattr(p2, "HOT", hot)
    monkeypatch.setattr(p2, "FAN", 2, raising=False)
    words = [RND.choice(WORDS) for _ in range(400)]
    text = lambda w: " ".join(w)
    texts = {1: text(words[:360]) + "...", 2: text(words) + ".", 3: text(words + [RND.choice(WORDS) for _ in range(200)]) + "."}
    texts |= {10 + k: text(words[:350] + [RND.choice(WORDS) for _ in range(11 + k)]) + "." for k in range(6)}  # go on otherwise
    texts |= {20 + k: text(words[: 355] + ["turn"] * (k + 50)) + "." for k in range(6)}
    texts |= {30: text(["other"] * 380)}
    feats, df = in_one_band(spark, texts)
    assert {r.row_id for r in p2.copies_that_go_on(feats, df, "row_id", "content").collect()} == {1}


def test_copies_are_aligned(spark):
    words = [RND.choice(WORDS) for _ in range(400)]
    early = words[:360]
    cut = {
        1: early[:40] + ["please", "visit", "our", "site"] + early[40:],
        2: early[:40] + early[41:],
        3: early[:3] + ["advert"] + early[3:200] + early[201:],
        4: early[:100] + ["sponsored"] * 20 + early[100:] + words[360:395],  # longer than the whole, and still cut
    }
    whole = " ".join(words) + "."
    for k, w in cut.items():
        assert p2.ends_early(" ".join(w) + "...", whole), k
    # ends where the other ends, though words are left out before
    assert not p2.ends_early(" ".join(words[:40] + words[41:]), whole)
    verse = "one lamp to guide us home tonight".split()
    assert not p2.ends_early(" ".join(words[5:] + verse + verse), " ".join(words + verse + verse))
    assert not p2.ends_early(" ".join(early[:100] + ["other"] * 80 + early[180:]), whole)
    texts = {k: " ".join(w) + "..." for k, w in cut.items()} | {9: whole}
    feats, df = in_one_band(spark, texts)
    got = {r.row_id for r in p2.copies_that_go_on(feats, df, "row_id", "content").collect()}
    assert got == {1, 2, 3, 4}


def test_planted_copies_are_found_by_their_bands(spark):
    """Copies cut at 0.82 to 0.97 of their words, some words changed on the way, among other stories."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3))
    rows, cut = [], set()
    for i in range(80):
        whole = [word() for _ in range(300)]
        early = whole[: int(300 * rnd.uniform(0.82, 0.97))]
        for _ in range(2):
            early[rnd.randrange(len(early) - 10)] = word()
        rows += [(2 * i, " ".join(whole) + ".", "s"), (2 * i + 1, " ".join(early) + "...", "s")]
        cut.add(2 * i + 1)
    df = spark.createDataFrame(rows, "row_id long, content string, source string")
    feats = p2.materialize(p2.features(df, "row_id", "content", "source"), "t")
    got = {r.row_id for r in p2.copies_that_go_on(feats, df, "row_id", "content").collect()}
    assert got <= cut and len(got) >= 0.9 * len(cut)
