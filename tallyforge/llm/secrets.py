"""Secret scans: fixed patterns, and Shannon entropy of windows that slide over candidate strings.

Everything is built-in DataFrame functions.  A text is first tested by one pattern; only texts that can hold a match
are searched further.  Positions come from splitting at the pattern: the lengths of the pieces and of the matches.

A candidate string is a run of at least 20 letters, digits and `+/_=.-`.  For each character class (hexadecimal digits,
digits with one case of letters, base64) a window of fixed width slides over it.  The counts of its characters
change by one entering and one leaving character a step, and so does the sum of c * log2(c) (kept in integers, so it
does not drift); a character outside the class starts the window anew.  A run of the class in which some window
reaches the entropy of the class is a secret unless the allow-list knows it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, with the least number of characters and whether that is of group 2 alone.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BASE = [("assign", ASSIGN, 6), ("access", ACCESS, 20), ("hex", HEX, 24)]

#: Least length of a candidate string.
CANDIDATE = 20
CANDIDATES = "[A-Za-z0-9+/_=.-]{%d,}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class CharClass:
    """Characters, width of the window, and the least entropy in bits that makes a run of them a secret.

    A window of random characters reaches about log2(width) less (width - 1) / (2 * size * ln 2) bits; the limits
    stand below that, and above what words of the same letters have.
    """

    name: str
    characters: str
    width: int
    bits: float

    @property
    def most(self) -> int:
        """The largest sum of c * log2(c), in units of 2^-20, at which a window has the entropy."""
        return math.floor((math.log2(self.width) - self.bits) * self.width * UNIT + 0.5)


UNIT = 2**20
CLASSES = (
    CharClass("hex", DIGITS + "abcdefABCDEF", 20, 3.0),
    CharClass("lower", DIGITS + LOWER, 20, 3.6),
    CharClass("upper", DIGITS + UPPER, 20, 3.6),
    CharClass("base64", DIGITS + LOWER + UPPER + "+/_=-", 24, 4.0),
)

#: Runs that are no secrets however mixed they look: letters alone or digits alone, words joined by separators, UUIDs,
#: alphabets and digits in order, and strings that say of themselves that they are no secret.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[+/_=-]*([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})([+/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)abcdefgh|12345678|qwertyui|deadbeef",
    r"(?i)example|sample|placeholder|changeme|dummy|your[_-]",
)


def clogc(c: int) -> int:
    """c * log2(c) in units of 2^-20."""
    return math.floor(c * math.log2(c) * UNIT + 0.5) if c > 1 else 0


def found_at(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, m>>: code points, end exclusive, and the match."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(matches, lambda m: F.length(m))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    both = F.arrays_zip(F.slice(gaps, 1, F.size(lengths)).alias("g"), lengths.alias("l"), matches.alias("m"))
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        end = start + x["l"]
        one = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    return F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])


def high_entropy_runs(string: Column, kind: CharClass) -> Column:
    """Runs of the class in which a window has the entropy, as array<struct<s, e>> within string."""
    w, k = kind.width, len(kind.characters)
    table = F.array(*[F.lit(clogc(c)) for c in range(w + 1)])
    zeros = F.array_repeat(F.lit(0), k)
    characters = F.concat(F.split(string, ""), F.array(F.lit("")))  # a last one outside every class ends the last run
    codes = F.transform(characters, lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(kind.characters), c)))
    none = F.array().cast("array<struct<s:int,e:int>>")

    def cost(c: Column) -> Column:
        return F.get(table, c)

    def step(codes: Column, state: Column, i: Column) -> Column:
        code = F.get(codes, i)
        inside = code > 0
        full = state["run"] >= w
        gone = F.when(full, F.get(codes, i - w)).otherwise(0)
        come, leave = F.get(state["counts"], code - 1), F.get(state["counts"], gone - 1)
        same = full & (gone == code)
        counts = F.transform(
            state["counts"], lambda c, j: c + F.when(j == code - 1, 1).otherwise(0) - F.when(j == gone - 1, 1).otherwise(0)
        )
        added = F.when(same, 0).otherwise(
            cost(come + 1) - cost(come) + F.when(full, cost(leave - 1) - cost(leave)).otherwise(0)
        )
        total = state["total"] + added
        run = state["run"] + 1
        on = F.struct(
            counts.alias("counts"), total.cast("long").alias("total"), run.alias("run"),
            (state["high"] | ((run >= w) & (total <= kind.most))).alias("high"), state["runs"].alias("runs"),
        )
        one = F.struct((i - state["run"]).alias("s"), i.alias("e"))
        off = F.struct(
            F.when(state["run"] == 0, state["counts"]).otherwise(zeros).alias("counts"), F.lit(0).cast("long").alias("total"),
            F.lit(0).alias("run"), F.lit(False).alias("high"),
            F.when(state["high"], F.concat(state["runs"], F.array(one))).otherwise(state["runs"]).alias("runs"),
        )
        return F.when(inside, on).otherwise(off)

    start = F.struct(
        zeros.alias("counts"), F.lit(0).cast("long").alias("total"), F.lit(0).alias("run"), F.lit(False).alias("high"), none.alias("runs"),
    )

    def scan(codes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(at, start, lambda state, i: step(codes, state, i), lambda s: s["runs"])

    return F.flatten(F.transform(F.array(codes), scan))


def of_kind(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e")))


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of array<struct<s, k, e>> by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    text = F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(text, ",")


def scan_secrets(
    docs: DataFrame, text_column: str = "text", classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """Add struct `secrets`: n_assign, n_access, n_hex, n_entropy (long), base and spans (kind:start:end, comma-joined).

    Base spans are the matches of the fixed patterns that are long enough; a match that is too short is dropped and its
    characters are not tried again.  Spans of kind `entropy` are runs of high entropy: of overlapping ones (of several
    classes) their union, and none that lies within a base span.  Positions count code points of the whole text, end
    exclusive.  The allow-list suppresses entropy spans only.

    Null and empty texts have no spans (n 0, empty strings).  Each row stands alone: repeated rows and null ids get
    their own result, an empty table stays empty.  Very long texts are scanned whole.  Other columns stay; one called
    `secrets` is replaced.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    kinds = [k for k, _, _ in BASE] + ["entropy"]
    empty = F.array().cast("array<struct<s:int,k:int,e:int>>")

    base = []
    for rank, (_, pattern, least) in enumerate(BASE):
        spans = found_at(text, pattern)
        if rank == 0:
            spans = F.filter(spans, lambda x: F.length(F.regexp_extract(x["m"], pattern, 2)) >= least)
        else:
            spans = F.filter(spans, lambda x: x["e"] - x["s"] >= least)
        base.append(of_kind(spans, rank))

    def runs_of(candidate: Column) -> Column:
        runs = F.concat(*[high_entropy_runs(candidate["m"], c) for c in classes])
        allow = F.lit("|".join(f"(?:{a})" for a in allowed) or "^$")
        runs = F.filter(runs, lambda r: ~F.regexp_like(F.substring(candidate["m"], r["s"] + 1, r["e"] - r["s"]), allow))
        return F.transform(runs, lambda r: F.struct((candidate["s"] + r["s"]).alias("s"), (candidate["s"] + r["e"]).alias("e")))

    def unite(spans: Column, x: Column) -> Column:
        last = F.get(spans, F.size(spans) - 1)
        wider = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        before = F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0)))
        return F.when(last["e"] > x["s"], F.concat(before, F.array(wider))).otherwise(F.concat(spans, F.array(x)))

    none = F.array().cast("array<struct<s:int,e:int>>")
    runs = F.array_sort(F.flatten(F.transform(found_at(text, CANDIDATES % CANDIDATE), runs_of)))
    high = F.aggregate(runs, none, unite)

    possible = text.rlike(f"{ASSIGN}|{CANDIDATES % CANDIDATE}")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "secrets"]
    first = docs.select(
        *kept,
        F.when(possible, F.struct(*[b.alias(k) for b, k in zip(base, kinds)], high.alias("high"))).alias("secrets"),
    )
    named = {k: F.coalesce(F.col(f"secrets.{k}"), empty) for k in kinds[:3]}
    within = F.concat(*named.values())
    outside = F.filter(F.coalesce(F.col("secrets.high"), none), lambda x: ~F.exists(within, lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"])))
    entropy = of_kind(outside, len(BASE))
    counts = [F.size(v).cast("long").alias(f"n_{k}") for k, v in [*named.items(), ("entropy", outside)]]
    found = F.struct(*counts, joined(within, kinds).alias("base"), joined(F.concat(within, entropy), kinds).alias("spans"))
    return first.select(*kept, found.alias("secrets"))
