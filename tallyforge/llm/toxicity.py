"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read a clause:

    lexicon     words -> classes INS (insult), THR (threat), TGT (target), NEG (negation), REP (reported speech), O;
                each word carries a weight
    reported    after REP, insults and threats become quoted ones
    negation    up to three words after NEG, insults and threats become denied ones
    target      an insult or threat with a target in the same clause counts more
    accept      what each kind of hit is worth

The last four are composed into one machine over classes.  A clause scores the weight of its best path; a document
is described by its scored clauses, not by single words, and a logistic model turns that into a probability.  The
lexicon's fixed insults are joined by words and stems learned from labelled rows, whose weights are their log odds;
they take the same way through the machine as fixed ones, as threats if they stand beside targets far more often than
clauses do otherwise.  A stem is learned only where words really part after it:
what always goes on in one way is learned as the longer stem or the whole word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches, discard, materialize

#: Fixed values of the grammar, by language.
INSULTS = {
    "en": "idiot idiots moron morons loser losers scum trash clown stupid worthless pathetic disgusting",
    "de": "idiot idioten dummkopf trottel versager abschaum clown dumm wertlos erbärmlich widerlich",
    "fr": "idiot idiote idiots crétin crétins perdant ordure clown stupide minable pathétique dégoûtant dégoûtante",
    "es": "idiota idiotas imbécil imbéciles perdedor escoria basura payaso estúpido estúpida patético asqueroso asquerosa",
}
THREATS = {
    "en": "kill hurt destroy beat smash punch stab shoot burn",
    "de": "töte töten umbringen umbringe schlage schlagen verprügeln zerstören verbrennen erschießen erstechen",
    "fr": "tue tuer tuerai frapper frapperai détruire cogner poignarder brûler abattre",
    "es": "mato matar mataré golpear golpearé destruir apuñalar disparar quemar",
}
TARGETS = {
    "en": "you your yours yourself u he she they them him her people",
    "de": "du dich dir dein deine deiner ihr euch euer er ihn sie ihnen leute",
    "fr": "tu te toi ton ta tes vous votre vos il elle ils elles eux leur gens",
    "es": "tú te ti tu tus usted ustedes vosotros él ella ellos ellas gente",
}
NEGATIONS = {
    "en": "not never no isn't aren't don't nobody without n't",
    "de": "nicht nie niemals kein keine keinen keiner niemand ohne",
    "fr": "pas jamais aucun aucune personne sans ni",
    "es": "no nunca jamás ningún ninguna nadie sin ni",
}
REPORTS = {
    "en": "said says called calls wrote writes quoted reported told",
    "de": "sagte sagt nannte nennt schrieb schreibt zitierte berichtete erzählte",
    "fr": "dit disait appelle appelait appelé écrit écrivait citait rapporte raconte",
    "es": "dijo dice llamó llama escribió escribe citó contó informó",
}
INSULT_WEIGHT, THREAT_WEIGHT, MOST_WEIGHT = 5.0, 3.0, 7.0

CLAUSE = re.compile(r"[.!?;:\n|]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLASSES = ("O", "INS", "THR", "TGT", "NEG", "REP")


class Machine:
    """Transducer over symbols; an arc (state, symbol) -> [(out, factor, bonus, next)].

    A path is worth the sum of factor * the word's weight + bonus over its arcs, plus the last state's final weight.
    """

    def __init__(self, start, arcs: dict, finals: dict):
        self.start, self.arcs, self.finals = start, arcs, finals

    def compose(self, other: Machine) -> Machine:
        """This machine's output is the other's input; only reachable pairs of states are made."""
        start = (self.start, other.start)
        arcs, finals, todo, seen = {}, {}, [start], {start}
        while todo:
            a, b = pair = todo.pop()
            if a in self.finals and b in other.finals:
                finals[pair] = self.finals[a] + other.finals[b]
            for (state, symbol), outs in self.arcs.items():
                if state != a:
                    continue
                for mid, factor, bonus, then in outs:
                    for out, factor2, bonus2, then2 in other.arcs.get((b, mid), ()):
                        nxt = (then, then2)
                        arcs.setdefault((pair, symbol), []).append((out, factor * factor2, bonus + bonus2, nxt))
                        if nxt not in seen:
                            seen.add(nxt)
                            todo.append(nxt)
        return Machine(start, arcs, finals)

    def best(self, clause: list[tuple[str, float]]) -> float:
        """Weight of the best path that reads the clause; 0 if there is none."""
        reach = {self.start: 0.0}
        for symbol, weight in clause:
            now: dict = {}
            for state, score in reach.items():
                for _, factor, bonus, then in self.arcs.get((state, symbol), ()):
                    value = score + factor * weight + bonus
                    if value > now.get(then, -math.inf):
                        now[then] = value
            reach = now
        return max((s + self.finals[q] for q, s in reach.items() if q in self.finals), default=0.0)


def reported_speech() -> Machine:
    arcs = {}
    for c in CLASSES:
        arcs["plain", c] = [(c, 1.0, 0.0, "quoted" if c == "REP" else "plain")]
        arcs["quoted", c] = [(f"Q{c}" if c in ("INS", "THR") else c, 1.0, 0.0, "quoted")]
    return Machine("plain", arcs, {"plain": 0.0, "quoted": 0.0})


def negation() -> Machine:
    arcs = {}
    for c in (*CLASSES, "QINS", "QTHR"):
        for left in range(4):
            after = 3 if c == "NEG" else max(0, left - 1)
            out = f"N{c}" if left and c in ("INS", "THR") else c
            arcs[left, c] = [(out, 1.0, 0.0, after)]
    return Machine(0, arcs, dict.fromkeys(range(4), 0.0))


def targets() -> Machine:
    """Whether a target and an attack are in one clause, in either order; threats need a target."""
    arcs = {}
    symbols = (*CLASSES, "QINS", "QTHR", "NINS", "NTHR")
    for c in symbols:
        for aimed in (False, True):
            for hit in (False, True):
                now = aimed or c == "TGT"
                attack = c in ("INS", "THR")
                bonus = 1.0 if (now and (hit or attack)) and not (aimed and hit) else 0.0
                out = "THR?" if c == "THR" and not now else c
                arcs[(aimed, hit), c] = [(out, 1.0, bonus, (now, hit or attack))]
    return Machine((False, False), arcs, {(a, h): 0.0 for a in (False, True) for h in (False, True)})


def accept() -> Machine:
    worth = {"INS": 1.0, "THR": 1.0, "THR?": 0.1, "QINS": 0.4, "QTHR": 0.3, "NINS": 0.3, "NTHR": 0.1}
    symbols = (*CLASSES, *worth)
    return Machine(0, {(0, c): [(c, worth.get(c, 0.0), 0.0, 0)] for c in symbols}, {0: 0.0})


def grammar() -> Machine:
    return reported_speech().compose(negation()).compose(targets()).compose(accept())


@dataclass
class Lexicon:
    """Whole words with their class and weight, and stems of insults; of several stems of a word the longest decides.

    Fixed words are not overridden by learned ones, nor whole words by stems.
    """

    words: dict[str, tuple[str, float]]
    stems: dict[str, float] = field(default_factory=dict)
    #: Which of the stems are threats.
    threats: frozenset[str] = frozenset()
    memo: dict = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, learned: dict[str, float], threats: frozenset[str] = frozenset()) -> Lexicon:
        """learned: weights of whole words, marked by END, and of stems; threats: those that only count when aimed."""
        whole = {w[: -len(END)]: ("THR" if w in threats else "INS", weight) for w, weight in learned.items() if w.endswith(END)}
        return cls(whole | fixed_words(), {w: weight for w, weight in learned.items() if not w.endswith(END)}, threats)

    def __post_init__(self):
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)

    def stem(self, word: str) -> str | None:
        return next((word[:k] for k in self.lengths if word[:k] in self.stems), None)

    def read(self, word: str) -> tuple[str, float]:
        got = self.words.get(word) or self.memo.get(word)
        if got is None:
            stem = self.stem(word)
            got = ("THR" if stem in self.threats else "INS", self.stems[stem]) if stem else self.words.get(word.partition("'")[2], OTHER)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = got
        return got


OTHER = ("O", 0.0)


def words_of(lists: dict[str, str]) -> list[str]:
    return [w for words in lists.values() for w in words.split()]


def fixed_words() -> dict[str, tuple[str, float]]:
    """All languages in one lexicon: texts mix them, and no word has two classes."""
    out: dict[str, tuple[str, float]] = {}
    for lists, kind, weight in ((INSULTS, "INS", INSULT_WEIGHT), (THREATS, "THR", THREAT_WEIGHT), (TARGETS, "TGT", 0.0), (NEGATIONS, "NEG", 0.0), (REPORTS, "REP", 0.0)):
        out |= dict.fromkeys(words_of(lists), (kind, weight))
    return out


def clauses(text: str) -> Iterator[list[str]]:
    for part in CLAUSE.split(text):
        words = TOKEN.findall(part)
        if words:
            yield words


FEATURES = ("hits", "attack", "words")


def describe(text: str | None, lexicon: Lexicon, machine: Machine) -> tuple[float, float, float]:
    """Clauses that match, the sum of their scores, and the number of words."""
    hits = attack = words = 0.0
    read = lexicon.read
    for clause in clauses((text or "").lower()):
        words += len(clause)
        tags = [read(w) for w in clause]
        if any(weight > 0 for _, weight in tags):
            score = machine.best(tags)
            attack += score
            hits += score > 0
    return hits, attack, words


def inputs(rows: np.ndarray) -> np.ndarray:
    """Model inputs: bounded shapes of the counts and of their rates for each hundred words."""
    hits, attack, words = rows.T
    rate = 100 / np.maximum(words, 20)
    shapes = [np.clip(attack / s, 0, 1) for s in (2, 5, 20)] + [np.clip(attack * rate / s, 0, 1) for s in (1.5, 3, 6, 12)]
    return np.column_stack([np.ones(len(rows)), *shapes, np.minimum(hits, 5) / 5])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Newton steps; the ridge keeps separable data finite and leaves the intercept alone."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-6)
        w -= np.linalg.solve(curve, x.T @ (p - y) + keep * w)
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray


#: What a learned word or stem needs: pairs of a toxic row and a word, how much commoner it is in toxic rows, and
#: standard deviations.  Stems have STEM_LETTERS, and so many different words.
LEAST_PAIRS, LEAST_RATIO, LEAST_STRENGTH = 3, 6, 3
STEM_LETTERS, STEM_WORDS, END = (4, 16), 5, "$"


def stem_counts(rows: DataFrame) -> DataFrame:
    """(stem, clean, toxic, words): pairs of a clean or toxic row and a different word with the stem, and such words.

    Whole words are stems with END.  Counts are summed over all rows (text, toxic) before anything is left out.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+(?:'\p{L}+)?"), F.lit(0)))
    counts = rows.select("toxic", F.explode(words).alias("word")).groupBy("word")
    counts = counts.agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    low, high = STEM_LETTERS
    n = F.least(F.length("word"), F.lit(high))
    stems = F.transform(F.sequence(F.lit(low), F.greatest(n, F.lit(low))), lambda k: F.substring(F.col("word"), F.lit(1), k))
    stems = F.when(n >= low, stems).otherwise(F.array().cast("array<string>"))
    stems = F.concat(stems, F.array(F.concat("word", F.lit(END))))
    by = counts.select(F.explode(stems).alias("stem"), "clean", "toxic").groupBy("stem")
    return by.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.count("*").alias("words"))


def choose_stems(table: list[tuple[str, int, int, int, float, float]]) -> dict[str, float]:
    """Weights of the stems of a table (stem, clean, toxic, words, odds, strength) that are no part of a better one.

    A stem goes if nine tenths of its toxic pairs go on in one way, or if too few different words have it; so
    `trash` is learned as a word and no shorter beginning of it.  Of stems that begin alike the most telling stays.
    """
    toxic = {r[0]: r[2] for r in table}
    narrower: set[str] = set()  # stems that one way to go on accounts for
    for stem, n in toxic.items():
        parent = stem[: -len(END)] if stem.endswith(END) else stem[:-1]
        if n >= 0.9 * toxic.get(parent, math.inf):
            narrower.add(parent)
    chosen: dict[str, float] = {}
    stems: set[str] = set()
    for stem, _, _, n_words, odds, strength in sorted(table, key=lambda r: (-r[5] * math.log(r[4]), r[0])):
        whole = stem.endswith(END)
        if stem in narrower or not whole and n_words < STEM_WORDS:
            continue
        word = stem[: -len(END)] if whole else stem
        if any(word[:k] in stems for k in range(1, len(word) + 1)) or not whole and any(s.startswith(stem) for s in stems):
            continue
        chosen[stem] = min(math.log(odds), MOST_WEIGHT)
        if not whole:
            stems.add(stem)
    return chosen


def learned_stems(rows: DataFrame, clean_rows: int, toxic_rows: int) -> dict[str, float]:
    """Weights of what tells toxic rows (text, toxic) from clean ones.

    What the driver gets needs LEAST_PAIRS toxic pairs a stem, so it is bounded by the toxic rows of the sample.
    """
    odds = (F.col("toxic") + 0.5) / toxic_rows / ((F.col("clean") + 0.5) / clean_rows)
    expected = (F.col("clean") + 0.5) / clean_rows * toxic_rows
    strength = (F.col("toxic") - expected) / F.sqrt(F.col("toxic") + expected)
    telling = (F.col("toxic") >= LEAST_PAIRS) & (odds >= LEAST_RATIO) & (strength >= LEAST_STRENGTH)
    return choose_stems([tuple(r) for r in stem_counts(rows).filter(telling).select("*", odds, strength).collect()])


#: A learned word is a threat if so large a part of its clauses has a target, so many more than clauses in general,
#: and it is in so many clauses.
AIMED_SHARE, AIMED_RATIO, AIMED_CLAUSES = 0.8, 2.0, 10


def aimed_words(rows: DataFrame, learned: dict[str, float]) -> frozenset[str]:
    """The learned words and stems of toxic rows that stand beside targets: one count each and for all clauses."""
    lexicon, aims = Lexicon.of(learned), set(words_of(TARGETS))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        for pdf in batches:
            for text in pdf["text"]:
                for clause in clauses(text.lower()):
                    aimed = not aims.isdisjoint(clause)
                    own = {w + END if w + END in learned else lexicon.stem(w) for w in clause} - {None}
                    for w in (*own, ""):
                        row = seen.setdefault(w, [0, 0])
                        row[0] += 1
                        row[1] += aimed
        yield pd.DataFrame([(w, *n) for w, n in seen.items()], columns=["word", "n", "aimed"])

    counts = rows.filter("toxic = 1").select("text").mapInPandas(count, "word string, n long, aimed long")
    found = {r["word"]: (r["n"], r["aimed"]) for r in counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("aimed").alias("aimed")).collect()}
    n, aimed = found.pop("", (1, 0))
    least = max(AIMED_SHARE, AIMED_RATIO * aimed / n)
    return frozenset(w for w, (m, hit) in found.items() if m >= AIMED_CLAUSES and hit >= least * m)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", key: str = "doc_id", sample: int = 20_000) -> Model:
    """Learn the lexicon's words and stems and the logistic model from the documents that labels names.

    About `sample` labels are used, by a seeded hash of their key; all if there are fewer.  That bounds the table
    of sampled labels, which is broadcast, so texts are not shuffled.  Null keys, texts and labels are passed over;
    repeated labels of a key count once, as the greater.  With no toxic or no clean row the fixed words decide.
    The model does not depend on how rows are dealt.
    """
    bounded_batches(docs.sparkSession)
    labels = labels.select(F.col(key).alias("k"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1) and k is not null")
    n = labels.count()
    labels = labels.filter(F.pmod(F.xxhash64(F.lit(5), "k"), F.lit(1_000_000)) < int(1e6 * min(1.0, sample / max(n, 1))))
    labels = labels.groupBy("k").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(key).alias("k"), F.col(text_col).alias("text")).filter("text is not null")
    rows = materialize(rows.join(F.broadcast(labels), "k").select("text", "toxic"), "toxicity-sample")
    clean_rows, toxic_rows = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not clean_rows or not toxic_rows:
        discard(rows)
        default = np.zeros(inputs(np.zeros((1, len(FEATURES)))).shape[1])
        default[:4] = -3.0, 2.0, 3.0, 1.0
        return Model(Lexicon.of({}), default)
    learned = learned_stems(rows, clean_rows, toxic_rows)
    lexicon, machine = Lexicon.of(learned, aimed_words(rows, learned) if learned else frozenset()), grammar()

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [describe(t, lexicon, machine) for t in pdf["text"]]
            yield pd.DataFrame(made, columns=FEATURES).assign(toxic=pdf["toxic"].to_numpy())

    seen = rows.mapInPandas(rows_of, "hits double, attack double, words double, toxic int").toPandas().sort_values([*FEATURES, "toxic"])
    discard(rows)
    return Model(lexicon, fit_logistic(inputs(seen[list(FEATURES)].to_numpy()), seen["toxic"].to_numpy(float)))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """docs with out_col: struct<score, hits, attack>.

    Null and empty texts get the score of a text without any match.  Very long texts are read whole, clause by clause.
    Equal texts get equal results; repeated rows and further columns don't matter, whatever they are called, but for
    one called out_col, which is replaced.  No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    machine = grammar()

    @F.pandas_udf("score double, hits double, attack double")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = np.array([describe(t, model.lexicon, machine) for t in texts]).reshape(-1, len(FEATURES))
        score = 1 / (1 + np.exp(-np.clip(inputs(rows) @ model.weights, -30, 30)))
        return pd.DataFrame({"score": score, "hits": rows[:, 0], "attack": rows[:, 1]})

    return docs.withColumn(out_col, run(F.col(text_col)))
