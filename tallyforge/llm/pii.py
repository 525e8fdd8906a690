"""Personal data by weak supervision.

Candidates are spans of eight kinds: the four base kinds, `secret` (long token-like strings), `number` (nine digits),
`name` (a given name of a list, or what follows a title, with or without a surname) and `address` (a street with or
without a number, as English, German, French and Spanish write it).  Three
families of labelers vote on each candidate, +1 (personal), -1 (not) or 0 (no opinion): regex labelers look at the
form, gazetteer labelers at lists of cue words, surnames, titles and places, context labelers at what stands around.
How often each pattern of votes occurs in the whole corpus is counted by Spark; expectation-maximisation over these
counts estimates every labeler's reliability, and a logistic classifier of span features is then fitted to the
resulting posteriors.  The classifier decides the spans that are no base spans; base spans are always kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone", "secret", "number", "name", "address")
BASE = KINDS[:4]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs begun at the head of a run match what the plain patterns match, in time linear in the text.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{20,}+")
NUMBER = re.compile(r"(?<![0-9A-Za-z.+@-])[0-9](?:-?[0-9]){8}(?![0-9A-Za-z@-])")

#: Words that tell the kind of what stands beside them.
NEAR = {
    "email": {"email", "mail", "mailto", "contact", "from", "to", "cc"},
    "ip": {"ip", "host", "server", "addr", "address", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "pan"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "cell"},
    "secret": {"token", "secret", "key", "apikey", "api_key", "password", "passwd", "pwd", "auth", "bearer"},
    "number": {"ssn", "passport", "id", "tax", "licence", "license", "account", "iban"},
    "name": {"name", "named", "contact", "dear", "signed", "author", "by", "from", "mr", "mrs", "ms", "dr", "prof", "herr", "frau", "monsieur", "madame", "senor", "senora", "nombre", "nom"},
    "address": {"address", "lives", "live", "street", "home", "ship", "adresse", "wohnt", "habite", "vive", "direccion", "dirección", "domicilio", "domicile", "anschrift"},
}
#: Common given names, surnames and cities of English, German, French and Spanish speaking countries.
GIVEN = {
    "en": "James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Andrew Kenneth Joshua Kevin Brian George Edward "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Ashley Emily Michelle Laura Rebecca Helen Anna",
    "de": "Hans Peter Wolfgang Klaus Jürgen Stefan Andreas Markus Uwe Dieter Heinz Jens Lukas Felix Jonas Karl Friedrich Matthias Sebastian Florian "
    "Ursula Monika Petra Sabine Claudia Heike Renate Birgit Katrin Lena Hannah Greta Ingrid Helga Gisela Anja Silke Johanna",
    "fr": "Jean Pierre François Philippe Nicolas Michel Alain Jacques Luc Antoine Julien Mathieu Olivier Thierry Guillaume Laurent Étienne Henri "
    "Marie Sophie Camille Isabelle Nathalie Catherine Chloé Élodie Julie Manon Céline Aurélie Sylvie Valérie Hélène Amélie Claire Brigitte",
    "es": "José Juan Carlos Miguel Javier Fernando Alejandro Antonio Francisco Manuel Pedro Luis Jorge Pablo Sergio Diego Rafael Andrés Álvaro Raúl "
    "María Carmen Lucía Elena Isabel Pilar Ana Marta Cristina Rosa Teresa Dolores Beatriz Raquel Silvia Paula Alba Sofía",
}
SURNAMES = {
    "en": "Smith Johnson Williams Brown Jones Miller Davis Wilson Anderson Taylor Thomas Moore Jackson Martin Lee Thompson White Harris Clark Lewis Walker Hall "
    "Young King Wright Scott Green Baker Adams Nelson Carter Mitchell Roberts Turner Phillips Campbell Parker Evans Edwards Collins",
    "de": "Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Koch Bauer Richter Klein Wolf Schröder Neumann Schwarz Zimmermann Braun "
    "Krüger Hofmann Hartmann Lange Werner Krause Lehmann Schmid Schulze Maier Köhler Herrmann",
    "fr": "Bernard Dubois Durand Leroy Moreau Simon Laurent Lefebvre Michel Garcia Petit Robert Richard Roux Fournier Girard Bonnet Dupont Lambert Fontaine "
    "Rousseau Vincent Mercier Blanc Guérin Boyer Garnier Chevalier François Legrand Gauthier Perrin",
    "es": "García Rodríguez González Fernández López Martínez Sánchez Pérez Gómez Martín Jiménez Ruiz Hernández Díaz Moreno Muñoz Álvarez Romero Alonso Gutiérrez "
    "Navarro Torres Domínguez Vázquez Ramos Gil Ramírez Serrano Blanco Molina Morales Suárez",
}
PLACES = {
    "en": "london manchester birmingham liverpool leeds glasgow edinburgh dublin york boston chicago houston phoenix dallas austin seattle denver portland toronto sydney melbourne",
    "de": "berlin hamburg münchen munich köln cologne frankfurt stuttgart düsseldorf leipzig dresden hannover nürnberg bremen essen dortmund wien vienna graz zürich bern basel",
    "fr": "paris lyon marseille toulouse nice nantes lille bordeaux strasbourg montpellier rennes grenoble dijon reims bruxelles genève lausanne montréal québec",
    "es": "madrid barcelona valencia sevilla zaragoza bilbao málaga granada murcia alicante córdoba valladolid vigo gijón bogotá lima quito santiago caracas montevideo",
}
#: Titles before a name, kinds of streets, and the small words between a kind and a name.
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Monsieur|Madame|Señor|Señora|Sr|Sra|Don|Doña"
STREETS_EN = "Street|Road|Avenue|Lane|Drive|Boulevard|Square|Terrace|Court"
STREETS_DE = "straße|strasse|weg|platz|gasse|allee|ufer"
STREETS_FR = "rue|avenue|boulevard|place|chemin|allée|quai|impasse|cours"
STREETS_ES = "calle|avenida|plaza|paseo|camino|carrera|ronda|travesía"
SMALL_FR, SMALL_ES = "de|du|des|la|le|les", "de|del|la|las|los|el"



def either_case(words: str) -> str:
    """The alternatives of a pattern, and the same with a capital first letter."""
    return words + "|" + "|".join(w.capitalize() for w in words.split("|"))


CAPITAL = re.compile(r"(?<![\w-])[A-ZÀ-ÖØ-Þ][^\W\d_]+(?![\w-])")
NEXT_NAME = re.compile(r"[ ]+([A-ZÀ-ÖØ-Þ][^\W\d_]+(?:-[A-ZÀ-ÖØ-Þ][^\W\d_]+)?)(?!\w)")
TITLED = re.compile(rf"(?<!\w)(?:{TITLES})\.?[ ]+([A-ZÀ-ÖØ-Þ][^\W\d_]+(?:[ -][A-ZÀ-ÖØ-Þ][^\W\d_]+)?)(?!\w)")
STREET = re.compile(
    rf"(?<!\w)(?:[0-9]{{1,5}}[a-z]?,?[ ]+)?(?:[A-Z][^\W\d_]+[ ]+){{1,3}}(?:{STREETS_EN})(?!\w)"
    rf"|(?<!\w)[A-ZÄÖÜ][^\W\d_]*(?:{STREETS_DE})(?:[ ]+[0-9]{{1,4}}[a-z]?)?(?!\w)"
    rf"|(?<!\w)(?:[0-9]{{1,4}}(?:[ ]?(?:bis|ter))?,?[ ]+)?(?:{either_case(STREETS_FR)})[ ]+(?:(?:(?:{SMALL_FR})[ ]+|[ld]['’]))*[A-ZÀ-ÖØ-Þ][^\W\d_]+(?:[ -][A-ZÀ-ÖØ-Þ][^\W\d_]+)?(?!\w)"
    rf"|(?<!\w)(?:{either_case(STREETS_ES)})[ ]+(?:(?:{SMALL_ES})[ ]+)*[A-ZÀ-ÖØ-Þ][^\W\d_]+(?:[ ][A-ZÀ-ÖØ-Þ][^\W\d_]+)?(?:,?[ ]+(?:n[º°][ ]*)?[0-9]{{1,4}})?(?!\w)"
)
TITLE_WORDS = frozenset(TITLES.lower().split("|"))
#: Words joined by separators, with short numbers between them.
JOINED = re.compile(r"[_/+=-]*(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_/+=-]+(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[_/+=-]*")
#: One of these is in every street; looked for before the pattern is.
STREET_WORDS = (*STREETS_EN.split("|"), *STREETS_DE.split("|"), *(w + " " for w in either_case(f"{STREETS_FR}|{STREETS_ES}").split("|")))
MOST_GIVEN = 3


@dataclass(frozen=True)
class Gazetteers:
    """Lists that the gazetteer labelers look at; larger ones of one's own may take their place."""

    given: frozenset[str] = frozenset(w for words in GIVEN.values() for w in words.split())
    surnames: frozenset[str] = frozenset(w for words in SURNAMES.values() for w in words.split())
    places: frozenset[str] = frozenset(w for words in PLACES.values() for w in words.split())


LISTS = Gazetteers()
WORDS = re.compile(r"[^\W\d]+")
#: So many words before and after a span are near it.
NEAR_WORDS = 4
LABELERS = ("form", "mixed", "cue", "listed", "assigned", "apart")


def luhn(digits: str) -> bool:
    values = np.frombuffer(digits.encode(), np.uint8)[::-1].astype(int) - 48
    odd = values[1::2] * 2
    return (values[::2].sum() + (odd - 9 * (odd > 9)).sum()) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        hit = DOMAIN.match(text, at) if start < at else None
        if hit:
            yield start, hit.end()
            done = hit.end()
        at = text.find("@", max(at + 1, done))


def forms(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of everything that has the form of a base kind."""
    for start, end in emails(text):
        yield "email", start, end, True
    for m in IP.finditer(text):
        parts = m.group().split(".")
        yield "ip", m.start(), m.end(), all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in parts)
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        yield "card", m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 8 <= sum(c in "0123456789" for c in m.group()) <= 15


def names(text: str, lists: Gazetteers) -> Iterator[tuple[int, int]]:
    """Given names of the lists with what follows, MOST_GIVEN given names and a surname at most; names after a title."""
    done = 0
    for m in CAPITAL.finditer(text):
        if m.start() < done or m.group() not in lists.given:
            continue
        done, n = m.end(), 1
        while more := NEXT_NAME.match(text, done):
            if more[1] in lists.given and n == MOST_GIVEN:
                break
            done, n = more.end(), n + 1
            if more[1] not in lists.given:
                break
        yield m.start(), done
    for m in TITLED.finditer(text):
        first = re.split("[ -]", m[1], maxsplit=1)[0]
        if first not in lists.given:  # those are found above
            yield m.span(1)


def candidates(text: str, lists: Gazetteers = LISTS) -> list[tuple[str, int, int, bool]]:
    """Base forms, and the further ones that don't overlap a valid base span."""
    found = [x for x in forms(text) if x[3] or (x[0] in ("ip", "phone") or x[0] == "card" and x[2] - x[1] >= 16)]
    taken = sorted((s, e) for _, s, e, ok in found if ok)
    ends = [e for _, e in taken]
    more = [("secret", m.start(), m.end(), False) for m in TOKEN.finditer(text)]
    more += [("number", m.start(), m.end(), False) for m in NUMBER.finditer(text)]
    more += [("name", start, end, False) for start, end in names(text, lists)]
    if any(w in text for w in STREET_WORDS):
        more += [("address", m.start(), m.end(), False) for m in STREET.finditer(text)]
    for x in more:
        i = bisect_right(ends, x[1])
        if i == len(taken) or taken[i][0] >= x[2]:
            found.append(x)
    return found


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


class Around:
    """The words of a text and where they are, so that those near a span are found without reading the text again."""

    def __init__(self, text: str):
        self.text = text
        found = [(m.start(), m.end(), m.group().lower()) for m in WORDS.finditer(text)]
        self.starts, self.ends, self.words = ([x[i] for x in found] for i in range(3))

    def before(self, start: int) -> list[str]:
        i = bisect_right(self.ends, start)
        return self.words[max(0, i - NEAR_WORDS) : i]

    def after(self, end: int) -> list[str]:
        i = bisect_left(self.starts, end)
        return self.words[i : i + NEAR_WORDS]

    def assigned(self, start: int) -> bool:
        """Whether = or : stands before the span, blanks and a quote between them."""
        i = start - 1
        if i >= 0 and self.text[i] in "\"'":
            i -= 1
        while i >= 0 and self.text[i].isspace():
            i -= 1
        return i >= 0 and self.text[i] in "=:"


def votes_of(around: Around, kind: str, start: int, end: int, valid: bool, lists: Gazetteers = LISTS) -> tuple[int, ...]:
    text, listed = around.text, 0
    span, before, after = text[start:end], text[start - 1 : start] if start else "", text[end : end + 1]
    letters, digits = any(c.isalpha() for c in span), any(c.isdigit() for c in span)
    if kind in BASE:
        form, mixed = (1 if valid else -1), 0
    elif kind == "secret":
        form = 1 if digits else -1
        mixed = 1 if letters and digits and entropy(span) > 3.0 and not JOINED.fullmatch(span) else -1
    elif kind == "number":
        form, mixed = (1 if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", span) else 0), (1 if len(set(span)) > 3 else -1)
    elif kind == "name":
        titled = TITLE_WORDS.intersection(around.before(start)[-1:])
        form, mixed = (1 if " " in span or titled else -1), 0
        listed = 1 if re.split("[ -]", span)[-1] in lists.surnames else 0
    else:
        form, mixed = (1 if digits else -1), 0
        listed = 1 if lists.places.intersection(around.after(end)) else 0
    cue = 1 if NEAR[kind].intersection(around.before(start)) else -1
    assigned = 1 if around.assigned(start) else (-1 if kind == "secret" else 0)
    apart = 1 if (not before or before in " \t\n\"'(=:|,;<[") and (not after or after in " \t\n\"').,;:|>]!?%&$*#") else -1
    return form, mixed, cue, listed, assigned, apart


def features_of(around: Around, kind: str, start: int, end: int, votes: tuple) -> list[float]:
    span = around.text[start:end]
    digits = sum(c.isdigit() for c in span) / len(span)
    by_kind = [float(kind == k) * v for k in KINDS for v in (1.0, *votes)]
    return [1.0, digits, min(len(span), 64) / 64, entropy(span) / 6, *by_kind]


#: What EM starts from and holds to: each labeler's accuracy, worth so many votes, and how far it may rise.
ACCURACY = np.array([0.9, 0.8, 0.7, 0.8, 0.65, 0.65])
ACCURACY_VOTES, MOST_ACCURACY = 20.0, 0.98
#: A labeler that says the same of so large a part of a kind's candidates says nothing about it.
CONSTANT = 0.95


def fit_votes(counts: dict[tuple, int], rounds: int = 60) -> tuple[dict[tuple, float], np.ndarray]:
    """EM for a two-class model in which labelers err independently of each other, each with an accuracy for each kind.

    counts: (kind, *votes) -> how often.  Gives the posterior of every pattern and P(vote | class) as an array
    (labeler, class, vote + 1).  A vote of 0 is no evidence, nor are the votes of a labeler that says nearly always
    the same of a kind; an accuracy is never below a half, so classes can't change places.
    """
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    votes = np.array([k[1:] for k in keys], int).reshape(len(keys), -1)
    kinds = np.array([KINDS.index(k[0]) for k in keys], int)
    right = np.tile(ACCURACY, (len(KINDS), 1))
    for k in range(len(KINDS)):
        own = kinds == k
        for v in (-1, 1):
            same = ((votes[own] == v) * n[own, None]).sum(axis=0)
            votes[:, same >= CONSTANT * max(n[own].sum(), 1)] *= ~own[:, None]
    prior = np.full(len(KINDS), 0.5)
    post = np.full(len(keys), 0.5)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior))[kinds] + (votes * np.log(right / (1 - right))[kinds]).sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        for k in range(len(KINDS)):
            own = kinds == k
            prior[k] = np.clip((1 + (n * post)[own].sum()) / (2 + n[own].sum()), 0.02, 0.98)
            held = ((votes[own] > 0) * post[own, None] + (votes[own] < 0) * (1 - post[own, None])) * n[own, None]
            said = ((votes[own] != 0) * n[own, None]).sum(axis=0)
            right[k] = np.clip((held.sum(axis=0) + ACCURACY * ACCURACY_VOTES) / (said + ACCURACY_VOTES), 0.5, MOST_ACCURACY)
    trust = np.zeros((votes.shape[1], 2, 3))
    votes = np.array([k[1:] for k in keys], int).reshape(len(keys), -1)
    for j in range(votes.shape[1]):
        for c, share in ((0, 1 - post), (1, post)):
            seen = np.array([(n * share)[votes[:, j] == v].sum() for v in (-1, 0, 1)])
            trust[j, c] = (seen + 1 / 3) / (seen.sum() + 1)
    return dict(zip(keys, post.tolist())), trust


def fit_spans(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic classifier for soft labels, by plain gradient steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 2.0 * (x.T @ (p - y) / max(len(y), 1) + 1e-3 * w)
    return w


def majority(votes: tuple[int, ...]) -> bool:
    """What the labelers say when each counts the same; what estimated reliabilities are compared with."""
    return sum(votes) > 0


def fit(docs: DataFrame, text_col: str = "text", sample: int = 5000, lists: Gazetteers = LISTS) -> np.ndarray:
    """Weights of the span classifier.

    Vote patterns are counted over all documents.  The classifier itself is fitted on a bounded sample: of each kind
    and pattern of votes, the span with the smallest hash in each of sample / 64 buckets of hashes.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found = candidates(text or "", lists)
                around = Around(text) if found else None
                for kind, start, end, valid in found:
                    votes = votes_of(around, kind, start, end, valid, lists)
                    rows.append((kind, ",".join(map(str, votes)), features_of(around, kind, start, end, votes), hash_of(text[start:end])))
            yield pd.DataFrame(rows, columns=["kind", "votes", "x", "h"])

    spans = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "kind string, votes string, x array<double>, h long")
    # One pass: counts, and for each pattern and hash bucket the span with the smallest hash as a sample.
    share = max(1, sample // 64)
    table = spans.groupBy("kind", "votes", F.pmod("h", F.lit(share)).alias("b")).agg(F.count("*").alias("n"), F.min_by("x", "h").alias("x")).collect()
    if not table:
        return np.zeros(4 + (1 + len(LABELERS)) * len(KINDS))
    counts: Counter = Counter()
    for r in table:
        counts[(r["kind"], *map(int, r["votes"].split(",")))] += r["n"]
    post, _ = fit_votes(counts)
    x = np.array([r["x"] for r in table])
    y = np.array([post[(r["kind"], *map(int, r["votes"].split(",")))] for r in table])
    return fit_spans(x, y)


def hash_of(span: str) -> int:
    return int.from_bytes(hashlib.blake2b(span.encode("utf-8", "replace"), digest_size=7).digest(), "big")


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1])))


FOUND = "n_email long, n_ip long, n_card long, n_phone long, n_added long, base string, spans string"


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii", weights: np.ndarray | None = None, lists: Gazetteers = LISTS) -> DataFrame:
    """Add out_col: counts and spans (kind:start:end in code points) of personal data in text_col.

    `base` lists the base spans, `spans` all of them.  Null texts count as empty; very long ones are read whole, in
    time linear in their length; repeated rows give equal results; a span with even odds (a tie) is kept; other columns
    pass through, one called out_col is replaced.  No rows give no rows.  weights: from fit(); fitted on docs if not given.
    lists: names and places, broadcast to the tasks, so some ten thousand of them at most.
    """
    bounded_batches(docs.sparkSession)
    weights = fit(docs, text_col, lists=lists) if weights is None else weights

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base, added, around = [], [], None
            for kind, start, end, valid in candidates(text, lists):
                if valid:
                    base.append((kind, start, end))
                elif kind not in BASE:
                    around = around or Around(text)
                    votes = votes_of(around, kind, start, end, valid, lists)
                    if np.dot(weights, features_of(around, kind, start, end, votes)) >= 0:
                        added.append((kind, start, end))
            counts = Counter(k for k, _, _ in base)
            rows.append((*(counts[k] for k in BASE), len(added), joined(base), joined(base + added)))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")])

    return docs.withColumn(out_col, find(F.col(text_col)))


def mask_pii(text: str, spans: str) -> str:
    """text with every span replaced by its kind in angle brackets."""
    found = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]
