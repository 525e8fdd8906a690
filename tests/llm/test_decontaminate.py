import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.llm.decontaminate import BLOCKS, RADIUS, blocks, drop_leaks, find_leaks, flips
from tests.llm.conftest import prose


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(w):
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    """Pairs by sliding every item-sized window; shingles of one item weigh alike, so plain Jaccard decides here."""
    out = set()
    for i, t in docs:
        w = words(t)
        for k, b in items:
            v = words(b)
            if v and w and (grams(w) & grams(v) or len(v) < 5) and max((len(grams(w[s : s + len(v)]) & grams(v)) / len(grams(w[s : s + len(v)]) | grams(v)) for s in range(max(1, len(w) - len(v) + 1)))) >= 0.8:
                out.add((i, k))
    return out


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    items = [(k, prose(100 + k, 15 + 3 * k)) for k in range(12)]
    r, docs = random.Random(8), []
    for i in range(80):
        body, passage = prose(1000 + i, 60).split(), items[i % 12][1].split()
        if i % 4 == 0:  # whole
            docs.append((i, " ".join(body[:30] + passage + body[30:])))
        elif i % 4 == 1:  # one word changed near an end
            docs.append((i, " ".join(body[:10] + passage[:-1] + ["other"] + body[10:])))
        elif i % 4 == 2:  # half of it
            docs.append((i, " ".join(body + passage[: len(passage) // 2])))
        else:  # shuffled
            r.shuffle(passage)
            docs.append((i, " ".join(passage)))
    got = {(x.doc_id, x.item_id) for x in find_leaks(*frames(spark, docs, items)).collect()}
    assert got == brute(docs, items) and len(got) >= 20


def test_recall_of_moved_and_mixed_passages(spark):
    """Items with their parts swapped, cut in two with words between, or changed: all windows of brute force."""
    items = [(k, prose(300 + k, 100 + 7 * (k % 3))) for k in range(9)]
    r, docs = random.Random(12), []
    for i in range(90):
        w = items[i % 9][1].split()
        cut = r.randrange(20, len(w) - 20)
        body = prose(4000 + i, 150).split()
        if i % 3 == 0:  # halves swapped
            w = w[cut:] + w[:cut]
        elif i % 3 == 1:  # something between them, near what is still alike
            w = w[:cut] + body[100 : 100 + r.randrange(1, 12)] + w[cut:]
        else:  # words changed here and there
            for _ in range(r.randrange(1, 4)):
                w[r.randrange(len(w))] = "changed"
        docs.append((i, " ".join(body[:70] + w + body[70:])))
    want = brute(docs, items)
    got = {(x.doc_id, x.item_id) for x in find_leaks(*frames(spark, docs, items)).collect()}
    assert got <= want and len(want) >= 50 and {i % 3 for i, _ in want} == {0, 1, 2}
    assert len(got) >= 0.98 * len(want)


def test_rows_without_or_with_one_id_and_repeated_items(spark):
    item = prose(7, 25)
    docs = [(None, prose(i, 30)) for i in range(40)] + [(None, item), (3, "a b c"), (3, "x " + item)]
    items = [(1, item)] * 3 + [(2, item)]
    got = sorted(((x.doc_id, x.item_id) for x in find_leaks(*frames(spark, docs, items)).collect()), key=str)
    assert got == sorted([(None, 1), (None, 2), (3, 1), (3, 2)], key=str)


def test_form_hides_nothing(spark):
    item = prose(7, 25)
    docs = [(1, item.upper()), (2, item.replace(" ", "!!\n")), (3, "intro " + item), (3, "intro " + item), (4, " ".join(reversed(item.split()))), (None, item), (5, "ab cd")]
    items = [(1, item), (2, item), (3, "AB, cd."), (4, None), (5, ""), (None, "unseen words that nobody wrote down here")]
    got = [(x.doc_id, x.item_id) for x in find_leaks(*frames(spark, docs, items)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (None, 1), (None, 2), (5, 3)], key=str)


def test_awkward_and_empty(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, prose(2, 60), "x")], "item_id long, text string, n_lines string")
    assert {x.doc_id for x in find_leaks(awkward, bench).collect()} == {4}
    kept = drop_leaks(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 2
    assert find_leaks(nothing, bench).count() == 0 and find_leaks(awkward, bench.limit(0)).count() == 0
    assert drop_leaks(awkward, bench.limit(0)).count() == awkward.count()
    clash = awkward.withColumns({"_leak": F.lit(1), "id": F.lit(2), "_id": F.lit(3), "leaks": F.lit(4)})
    assert drop_leaks(clash, bench).columns == clash.columns and drop_leaks(clash, bench).count() == awkward.count() - 2


def test_native_plan(spark, awkward):
    bench = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    plan = find_leaks(awkward, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)


def test_probing_finds_everything_within_the_radius(spark):
    r, rows = random.Random(4), []
    for _ in range(300):
        f = r.getrandbits(64)
        g = f
        for b in r.sample(range(64), RADIUS):
            g ^= 1 << b
        rows.append((len(rows), f - (1 << 63), g - (1 << 63)))
    df = spark.createDataFrame(rows, "i long, f long, g long")
    index = df.select("i", F.explode(blocks(F.col("f"))).alias("b")).withColumn("flip", F.explode(flips(F.col("b.block"))))
    index = index.select("i", F.col("b.block").alias("block"), F.col("b.value").bitwiseXOR(F.col("flip")).alias("value"))
    probes = df.select(F.col("i").alias("j"), F.explode(blocks(F.col("g"))).alias("b")).select("j", "b.block", "b.value")
    assert probes.join(index, ["block", "value"]).filter("i = j").select("i").distinct().count() == 300
    assert sum(BLOCKS) == 64 and pytest.approx(RADIUS) == 17
