"""Language identification by a byte convolutional network.

A text is cut into windows of 256 bytes.  Every byte becomes an 8-vector; filters two, three and four bytes wide
slide over the window in steps of two, so no byte is passed over; the greatest response of each filter over the
window goes through a softmax layer.  A document's probabilities are those of its windows, averaged by length.

Training is numpy alone, on windows of a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches

WINDOW, REACH, DIM = 256, 4, 8
WIDTHS = (2, 3, 4)
BLOCK = 1024  # windows in hand at once
UNKNOWN = "und"


@dataclass
class Network:
    labels: list[str]
    embed: np.ndarray  # 256 x DIM; byte 0 pads and stays zero
    filters: np.ndarray  # REACH * DIM x filters; narrower filters are zero beyond their width
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def filter_mask(each: int) -> np.ndarray:
    """Which weights a filter of each width may use."""
    mask = np.zeros((REACH * DIM, each * len(WIDTHS)), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * DIM, i * each : (i + 1) * each] = 1
    return mask


def windows_of(text: bytes) -> np.ndarray:
    """Rows of WINDOW bytes, the last one padded with zeros; A-Z lower-cased."""
    text = text.lower()
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def pooled(net: Network, x: np.ndarray, where: bool = False):
    """Greatest response of each filter in each window (before the bias), and the byte it begins at."""
    rows, steps = len(x), WINDOW // REACH
    flat = net.embed[x].reshape(-1)
    even = (flat.reshape(-1, REACH * DIM) @ net.filters).reshape(rows, steps, -1)
    half = REACH // 2 * DIM
    # The same windows two bytes on; those that would reach into the next row are left out.
    odd = flat[half:-half].reshape(-1, REACH * DIM) @ net.filters
    odd = np.vstack([odd, np.zeros((1, odd.shape[1]), np.float32)]).reshape(rows, steps, -1)[:, :-1]
    top, other = even.max(1), odd.max(1)
    if not where:
        return np.maximum(top, other), None
    begin = np.where(top >= other, even.argmax(1) * REACH, odd.argmax(1) * REACH + REACH // 2)
    return np.maximum(top, other), begin


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str], each: int = 16, epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> Network:
    """Fit by Adam on windows (n x WINDOW bytes) and label numbers."""
    rng = np.random.default_rng(seed)
    n_filters, mask = each * len(WIDTHS), filter_mask(each)
    net = Network(
        labels,
        rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
        (rng.normal(0, 0.3, (REACH * DIM, n_filters)) * mask).astype(np.float32),
        np.zeros(n_filters, np.float32),
        rng.normal(0, 0.1, (n_filters, len(labels))).astype(np.float32),
        np.zeros(len(labels), np.float32),
    )
    net.embed[0] = 0
    names = ("embed", "filters", "bias", "dense", "offset")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x, y = windows[pick], targets[pick]
            top, begin = pooled(net, x, where=True)
            hidden = np.maximum(top + net.bias, 0)
            slope = softmax(hidden @ net.dense + net.offset)
            slope[np.arange(len(y)), y] -= 1
            slope /= len(y)
            back = (slope @ net.dense.T) * (hidden > 0)
            spans = x[np.arange(len(x))[:, None, None], begin[:, :, None] + np.arange(REACH)]
            patches = net.embed[spans].reshape(len(x), n_filters, REACH * DIM)
            grads = {
                "dense": hidden.T @ slope,
                "offset": slope.sum(0),
                "bias": back.sum(0),
                "filters": np.einsum("bf,bfk->kf", back, patches) * mask,
                "embed": np.zeros_like(net.embed),
            }
            pull = (back[:, :, None] * net.filters.T[None]).reshape(-1, DIM)
            np.add.at(grads["embed"], spans.reshape(-1), pull)
            grads["embed"][0] = 0
            step += 1
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                getattr(net, k)[...] -= (rate * move).astype(np.float32)
    return net


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Of each label for each text, whatever its length, in blocks of BLOCK windows."""
    sums = np.zeros((len(texts), len(net.labels)))
    held, owner, weight = [], [], []

    def flush():
        x = np.concatenate(held)
        for at in range(0, len(x), BLOCK):
            top, _ = pooled(net, x[at : at + BLOCK])
            p = softmax(np.maximum(top + net.bias, 0) @ net.dense + net.offset)
            part = slice(at, at + BLOCK)
            np.add.at(sums, np.concatenate(owner)[part], p * np.concatenate(weight)[part][:, None])
        for z in (held, owner, weight):
            z.clear()

    waiting = 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text)), BLOCK * WINDOW):
            part = text[start : start + BLOCK * WINDOW]
            held.append(windows_of(part))
            owner.append(np.full(len(held[-1]), i))
            share = np.full(len(held[-1]), float(WINDOW))
            share[-1] = max(1, len(part) - WINDOW * (len(share) - 1))
            weight.append(share)
            waiting += len(share)
            if waiting >= BLOCK:
                flush()
                waiting = 0
    if held:
        flush()
    return sums / np.maximum(sums.sum(1, keepdims=True), 1e-12)


def classify(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Label number and its probability for each text."""
    p = probabilities(net, texts)
    return p.argmax(1), p.max(1)


def sampled(labelled: DataFrame, text_col: str, lang_col: str, key: str, sample: int, each: int) -> list:
    """About `sample` labelled rows (2 * sample at most) as (lang, cuts, h): `each` windows of every one.

    Rows are taken by a seeded hash of their key, at the rate that gives `sample` of them, so that what comes to the
    driver doesn't grow with the table.  Rows with a null label, text or key, or without text, are passed over.
    """
    text, key_hash = F.col(text_col).cast("binary"), F.xxhash64(F.lit(5), key)
    known = F.col(lang_col).isNotNull() & F.col(key).isNotNull()
    n = labelled.filter(known).count()
    rows = labelled.filter(known & (F.octet_length(text_col) > 0) & (F.pmod(key_hash, F.lit(1_000_000)) < int(1e6 * min(1.0, sample / max(n, 1))) + 1))
    spread = F.greatest(F.octet_length(text_col) - WINDOW, F.lit(1))
    cuts = [F.substring(text, F.lit(1) + F.pmod(F.xxhash64(key, F.lit(k)), spread).cast("int"), WINDOW) for k in range(each)]
    rows = rows.select(F.col(lang_col).alias("lang"), F.array(*cuts).alias("cuts"), key_hash.alias("h")).limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["h"], r["lang"], r["cuts"]))
    return rows


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id", sample: int = 3000, each: int = 3) -> Network | None:
    """Train on a bounded sample of labelled rows, `each` windows of every one; with none there is no network."""
    rows = sampled(labelled, text_col, lang_col, key, sample, each)
    if not rows:
        return None
    labels = sorted({r["lang"] for r in rows})
    x = np.concatenate([windows_of(bytes(c))[:1] for r in rows for c in r["cuts"]])
    y = np.array([labels.index(r["lang"]) for r in rows for _ in r["cuts"]])
    return train(x, y, labels)


@dataclass
class Gate:
    """A network whose last label is no language, and the probability of that label from which a text goes."""

    net: Network
    limit: float


#: First letters of scripts that noise is drawn from.
SCRIPTS = (0x61, 0x391, 0x430, 0x561, 0x5D0, 0x628, 0x905, 0xE01, 0x10D0, 0x3042, 0x4E00, 0xAC00)
GATE_LEAST, GATE_QUANTILE, GATE_MARGIN = 0.98, 0.99, 20.0


def noise_of(cut: bytes, rng: np.random.Generator) -> bytes:
    """Letters that are no language, as long as cut: its own in another order, random ones, or a few repeated."""
    kind = rng.integers(4)
    if kind == 0:
        chars = list(cut.decode("utf-8", "ignore"))
        return "".join(chars[i] for i in rng.permutation(len(chars))).encode()[: len(cut)]
    first = SCRIPTS[rng.integers(len(SCRIPTS))] if kind == 2 else SCRIPTS[0]
    letters = [chr(first + i) for i in rng.integers(0, 26, 1 + len(cut))]
    if kind == 3:
        letters = letters[: rng.integers(1, 5)] * (1 + len(cut))
    ends = np.cumsum(rng.integers(2, 12, 1 + len(cut)))
    words = ["".join(letters[a:b]) for a, b in zip([0, *ends], ends) if a < len(letters)]
    return " ".join(words).encode()[: len(cut)]


def fit_gate(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id", sample: int = 2000, each: int = 2) -> Gate | None:
    """Learn to tell texts in the labelled languages from letters that are no language.

    Four in five sampled rows train, against as many made-up windows; half of all are cut short, so that short texts
    are not judged by what only long ones have.  The limit is calibrated on the fifth held out: the odds of being no
    language must be GATE_MARGIN times those which 99 % of its windows stay below, and GATE_LEAST at least.  Without
    held-out rows there is no gate.
    """
    rows = sampled(labelled, text_col, lang_col, key, sample, each)
    held, rows = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    if not rows:
        return None
    rng = np.random.default_rng(17)

    def shortened(r) -> list[bytes]:
        cuts = [bytes(c) for c in r["cuts"] if c]
        return [c[: rng.integers(4, 100)] if rng.random() < 0.5 else c for c in cuts]

    labels = sorted({r["lang"] for r in rows})
    own = [(c, labels.index(r["lang"])) for r in rows for c in shortened(r)]
    made = [(noise_of(c, rng), len(labels)) for c, _ in own]
    x = np.concatenate([windows_of(c)[:1] for c, _ in own + made])
    net = train(x, np.array([y for _, y in own + made]), [*labels, UNKNOWN])
    top = float(np.quantile(probabilities(net, [c for r in held for c in shortened(r)])[:, -1], GATE_QUANTILE))
    return Gate(net, max(GATE_LEAST, GATE_MARGIN * top / (GATE_MARGIN * top + 1 - top)))


def has_language(gate: Gate | None, text: Column) -> Column:
    """False where text is null, has no letter, or is no language by the gate; without a gate letters decide."""
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if gate is None:
        return known
    held = gate

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(probabilities(held.net, [t or b"" for t in texts])[:, -1] <= held.limit)

    return known & run(F.when(known, text.cast("binary")))


def predict(net: Network | None, text: Column) -> Column:
    """struct<lang: string, score: double>; `und` and 0 where text is null or has no letter."""
    if net is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    held = net

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        best, p = classify(held, [t or b"" for t in texts])
        return pd.DataFrame({"lang": [held.labels[i] for i in best], "score": p})

    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    found = run(F.when(known, text.cast("binary")))
    return F.struct(
        F.when(known, found["lang"]).otherwise(UNKNOWN).alias("lang"), F.when(known, found["score"]).otherwise(0.0).alias("score")
    )


def identify_languages(docs: DataFrame, training: DataFrame, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """docs with out_col: struct<lang, score>, learned from training (text, lang, doc_id).

    Null texts and texts without a letter are `und` with score 0.  Equal texts get equal results; repeated rows,
    ties and further columns don't matter, whatever they are called.  Without any labelled row all is `und`.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out_col, predict(fit(training), F.col(text_col)))


def fold(key: str, parts: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts
