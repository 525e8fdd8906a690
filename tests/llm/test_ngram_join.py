import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.llm import ngram_join
from tallyforge.llm.components import stars
from tallyforge.llm.ngram_join import keep_one_of_each, parted_overlap, similar_groups, similar_pairs
from tallyforge.llm.shingles import sets_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted(((k, len(s), low.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_groups(df).collect()), key=str)


def near_copies(seed, n, words=80, most=8):
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(most)):
            w[r.randrange(words)] = f"v{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_against_brute_force(spark):
    texts = near_copies(1, 60) + near_copies(2, 40, 30, 3) + near_copies(3, 20, 7, 2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{i}x{j}" for j in range(5 + i % 40)) for i in range(40)] + texts[:25]
    random.Random(9).shuffle(texts)
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("each", [0.01, 64])
def test_pivots_lose_no_link(spark, monkeypatch, each):
    monkeypatch.setattr(ngram_join, "PAIRS_EACH", each)
    rows = list(enumerate(near_copies(4, 90, 60, 12)))
    assert found(spark, rows) == brute(rows)


def test_awkward_and_empty(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(spark, rows) == brute(rows)
    assert similar_groups(awkward).count() == awkward.count()
    assert similar_groups(nothing).count() == 0
    kept = keep_one_of_each(awkward)
    assert {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 7, 8, 10, 12, 13, None} and kept.columns == awkward.columns


def test_pairs(spark):
    texts = near_copies(5, 30)
    links, members = similar_pairs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    key = {r.doc_id: r.c for r in members.collect()}
    got = {(r.a, r.b): round(r.similarity, 9) for r in links.collect()}
    sets = [shingles(t) for t in texts]
    want = {}
    for i in range(30):
        for j in range(i):
            s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if s >= 0.8 and sets[i] != sets[j]:
                want[tuple(sorted((key[i], key[j])))] = round(s, 9)
    assert got == want


def test_the_suffix_filter_never_drops_a_true_pair(spark):
    """At every shingle that two sets share, what the filter allows is at least what they have in common."""
    r, rows = random.Random(6), []
    for _ in range(400):
        pool = r.sample(range(10**6), r.choice([12, 40, 200]))
        a, b = (sorted(r.sample(pool, r.randrange(len(pool) // 2, len(pool)))) for _ in range(2))  # sorted: the global order
        of = {x: r.randrange(16) for x in pool}
        common = set(a) & set(b)
        for x in common:
            counts = [[sum(of[y] == k for y in s) for k in range(16)] for s in (a, b)]
            heads = ["".join(f"{of[y]:x}" for y in s[: s.index(x) + 1]) for s in (a, b)]
            rows.append((*counts, *heads, len(common)))
    df = spark.createDataFrame(rows, "ra array<int>, rb array<int>, ha string, hb string, common int")
    most = parted_overlap((F.col("ra"), F.col("rb")), (F.col("ha"), F.col("hb")))
    whole = F.aggregate(F.zip_with("ra", "rb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    got = df.select(most.alias("most"), whole.alias("whole"), "common").toPandas()
    assert (got.most >= got.common).all() and (got.most <= got.whole).all() and (got.most < got.whole).mean() > 0.5


def test_a_star_of_many_links(spark):
    """One node holds nearly all links, more than a lookup leaves together."""
    links = spark.range(1, 6000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).unionByName(spark.createDataFrame([(7000, 7001), (7001, 3)], "a long, b long"))
    got = stars(links.repartition(5))
    assert got.count() == 6001 and got.filter("root <> 0").count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in stars(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


texts = st.lists(st.text(alphabet="abAB é\n\t 1", max_size=60), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_hashed_sets_have_the_sizes_and_overlaps_of_real_ones(batch):
    hashed = [set(map(int, s)) for s in sets_of(pa.array([t.encode() for t in batch], pa.binary()))]
    real = [shingles(t) for t in batch]
    for a, b in zip(hashed, real):
        assert len(a) == len(b)
        for c, d in zip(hashed, real):
            assert len(a & c) == len(b & d)


def test_slices_of_a_batch():
    whole = pa.array([b"a b c d e f", b"", b"x y", b"a b c d e f"], pa.binary())
    assert [list(s) for s in sets_of(whole.slice(2, 2))] == [list(s) for s in sets_of(whole)][2:]
    assert np.array_equal(sets_of(whole)[0], sets_of(whole)[3])
