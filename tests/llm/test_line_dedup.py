import random
from collections import defaultdict

import numpy as np

from tallyforge.llm.line_dedup import CHUNK, counts_as_key, dedup_lines, line_key, merge_filters, or_at, spots


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = line_key(x.encode())
            if i is not None and counts_as_key(k):
                holders[k].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[k := line_key(x.encode())]) < 2 or min(holders[k]) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(df).select("doc_id", "text", "n_lines", "n_dropped").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_against_brute_force(spark):
    r = random.Random(5)
    lines = [f"line number {i} of the pool" for i in range(30)] + ["short", "", "  ", "Éclair été là-bas", "ÉCLAIR été là-bas"]
    check(spark, [(r.randrange(60), "\n".join(r.choice(lines) for _ in range(r.randrange(8)))) for _ in range(200)])


def test_edges(spark):
    same = "the very same long line"
    check(spark, [(3, same), (1, f"{same}\nother line here 1"), (1, same), (None, same), (None, None), (2, None), (4, ""), (5, f"  {same.upper()}\t\n{same}")])


def test_one_hot_line(spark):
    check(spark, [(i, f"the line that all documents share\nown line of document {i}") for i in range(3000)])


def test_awkward_and_empty(spark, awkward, nothing):
    out = dedup_lines(awkward)
    assert out.count() == awkward.count() and dict(out.dtypes)["n_lines"] == "bigint" and "source" in out.columns
    assert dedup_lines(nothing).count() == 0


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(3)
    words = CHUNK
    a, b = (rng.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(2))
    shared = a[:100]
    b = np.concatenate([b, shared])

    def part(h):
        at, once = or_at(*spots(np.unique(h), words))
        return {"at": at.astype(np.int32).tobytes(), "once": once.tobytes(), "twice": bytes(8 * len(at))}

    merged = merge_filters([part(a), part(b)])
    twice = np.zeros(words, np.uint64)
    twice[np.frombuffer(merged["at"], np.int32)] = np.frombuffer(merged["twice"], np.uint64)
    at, mask = spots(shared, words)
    assert ((twice[at] & mask) == mask).all()
    at, mask = spots(a[100:], words)
    assert ((twice[at] & mask) == mask).mean() < 0.02
