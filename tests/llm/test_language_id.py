import random

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm.language_id import WINDOW, classify, fit, identify_languages, pooled, predict, softmax, train, windows_of

STEMS = {"en": ["the", "and", "ing", "tion", "with"], "de": ["der", "und", "sch", "keit", "für"], "fr": ["les", "des", "eau", "ment", "été"]}


def text(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(STEMS[lang]) for _ in range(r.randrange(1, 3))) for _ in range(n))


def test_pooling_equals_plain_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 256, (3, WINDOW)).astype(np.uint8)
    net = train(x, np.array([0, 1, 0]), ["a", "b"], each=2, epochs=1)
    top, begin = pooled(net, x, where=True)
    for r in range(3):
        for f in range(net.filters.shape[1]):
            responses = {p: float(net.embed[x[r, p : p + 4]].reshape(-1) @ net.filters[:, f]) for p in range(0, WINDOW - 3, 2)}
            assert abs(max(responses.values()) - top[r, f]) < 1e-4 and abs(responses[int(begin[r, f])] - top[r, f]) < 1e-4


def test_gradients_learn_and_long_texts_use_all_windows():
    langs = sorted(STEMS)
    texts = [(text(k, i, 40), langs.index(k)) for i in range(120) for k in langs]
    x = np.concatenate([windows_of(t.encode())[:1] for t, _ in texts])
    net = train(x, np.array([y for _, y in texts]), langs)
    held = [(text(k, 10_000 + i, 30), langs.index(k)) for i in range(40) for k in langs]
    best, p = classify(net, [t.encode() for t, _ in held])
    assert np.mean(best == [y for _, y in held]) > 0.98 and ((p > 0) & (p <= 1)).all()
    mixed = (text("en", 1, 400) + text("de", 2, 4000)).encode()
    assert langs[classify(net, [mixed])[0][0]] == "de"
    assert softmax(np.array([[1000.0, 0.0]]))[0, 0] == 1.0


def test_query_semantics(spark, awkward, nothing):
    rows = [(i, text(k, i, 30), k) for i in range(90) for k in STEMS]
    training = spark.createDataFrame(rows + [(1, None, "en"), (2, "x", None), (None, "y", "en")], "doc_id long, text string, lang string")
    out = identify_languages(awkward, training)
    assert out.columns == [*awkward.columns, "language"] and out.count() == awkward.count()
    got = {r.doc_id: (r.language.lang, r.language.score) for r in out.collect()}
    assert got[5] == got[6] == got[7] == got[12] == ("und", 0.0)
    assert got[1][0] in STEMS and 0 <= got[1][1] <= 1 and identify_languages(nothing, training).count() == 0
    assert fit(training.limit(0)) is None
    assert {r.v.lang for r in awkward.select(predict(None, F.col("text")).alias("v")).collect()} == {"und"}
    assert identify_languages(awkward, training).collect() == out.collect()
