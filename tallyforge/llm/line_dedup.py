"""Line dedup with two Bloom filters.

1. Every partition notes the hashes of its line keys in a once filter, and those of keys that a second document
   of the partition holds in a twice filter.  Merging two partitions keeps a bit as twice-seen if either has it
   twice or both have it once, so the merged twice filter holds every key that two documents share.
2. Lines that miss the twice filter stay where they are.  Only suspected repeats are shuffled: grouping by the
   whole key confirms that two documents hold it and finds the smallest id.
3. The lines to drop are gathered for each document and taken out of its text.  Texts without a suspected line stay
   where they are; only the others meet their drop lists in a shuffle.

The filters are sized at 16 bits a line and bounded by filter_mb, which is also what each Python worker and the
driver hold.  Where the corpus has more lines than that, more of them are suspected and shuffled; the result is
the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded_batches, discard, lookup_join, materialize, merged_arrays

LEAST_CHARS = 10
#: Filter words (of 64 bits) in one chunk of a merged filter.
CHUNK = 1 << 16


def line_key(line: bytes) -> bytes:
    """bytes.strip and bytes.lower know ASCII only, as the key's definition does."""
    return line.strip().lower()


def counts_as_key(key: bytes, least: int = LEAST_CHARS) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)


def line_keys(text: bytes | None) -> list[bytes]:
    return list({k for k in map(line_key, (text or b"").split(b"\n")) if counts_as_key(k)})


def spots(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter word of each hash and its mask of four bits there."""
    one, mask = np.uint64(1), np.zeros(len(hashes), np.uint64)
    for k in range(4):
        mask |= one << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return ((hashes >> np.uint64(24)) % np.uint64(words)).astype(np.int64), mask


def or_at(index: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(index):
        return index, mask
    order = np.argsort(index, kind="stable")
    index, mask = index[order], mask[order]
    starts = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    return index[starts], np.bitwise_or.reduceat(mask, starts)


def partition_filters(words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = [np.zeros(0, np.uint64)]
        for batch in batches:
            digests = [xxhash.xxh3_64_intdigest(k) for t in batch.column("text") for k in line_keys(t.as_py())]
            found.append(np.array(digests, dtype=np.uint64))
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        index, once = or_at(*spots(hashes, words))
        twice_at, twice_mask = or_at(*spots(hashes[counts > 1], words))
        twice = np.zeros(len(index), np.uint64)
        twice[np.searchsorted(index, twice_at)] = twice_mask
        part = TaskContext.get().partitionId()
        for chunk in np.unique(index // CHUNK):
            low, high = np.searchsorted(index, [chunk * CHUNK, (chunk + 1) * CHUNK])
            own = (index[low:high] - chunk * CHUNK).astype(np.int32)
            row = [int(chunk), part, own.tobytes(), once[low:high].tobytes(), twice[low:high].tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32()] + [pa.binary()] * 3)],
                names=["chunk", "part", "at", "once", "twice"],
            )

    return build


def merge_filters(rows: list[dict]) -> dict:
    once, twice = np.zeros(CHUNK, np.uint64), np.zeros(CHUNK, np.uint64)
    for r in rows:
        at = np.frombuffer(r["at"], np.int32)
        o, t = np.frombuffer(r["once"], np.uint64), np.frombuffer(r["twice"], np.uint64)
        twice[at] |= t | (once[at] & o)
        once[at] |= o
    at = np.flatnonzero(once).astype(np.int32)
    return {"at": at.tobytes(), "once": once[at].tobytes(), "twice": twice[at].tobytes()}


def suspected_keys(texts: Iterator[bytes | None], twice: np.ndarray, words: int) -> tuple[list[bytes], np.ndarray]:
    """The keys that hit the twice filter, each with the place of its text."""
    keys, rows = [], []
    for i, t in enumerate(texts):
        own = line_keys(t)
        keys += own
        rows += [i] * len(own)
    index, mask = spots(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64), words)
    hit = np.flatnonzero((twice[index] & mask) == mask)
    return [keys[i] for i in hit], np.array(rows, np.int64)[hit]


def suspects_of(held, words: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(held.value, np.uint64)
        for batch in batches:
            keys, rows = suspected_keys((t.as_py() for t in batch.column("text")), twice, words)
            ids = batch.column("id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), ids], names=["key", "id"])

    return find


def is_suspected(held, words: int):
    """UDF: whether a text (binary) has a line that hits the twice filter.  A text that has none loses nothing."""

    def flag(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        out[suspected_keys(texts, np.frombuffer(held.value, np.uint64), words)[1]] = True
        return pd.Series(out)

    return F.pandas_udf(flag, "boolean")


def strip_lines(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    kept, total, gone = [], [], []
    for text, drop in zip(texts, drops):
        lines = (text or b"").split(b"\n")
        drop = set(drop) if drop is not None else ()
        left = [x for x in lines if line_key(x) not in drop] if drop else lines
        kept.append(b"\n".join(left))
        total.append(len(lines))
        gone.append(len(lines) - len(left))
    return pd.DataFrame({"kept": kept, "n_lines": total, "n_dropped": gone})


def line_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_mb: int = 64) -> DataFrame:
    """docs with the lines that an earlier document already has taken out of text_col.

    A line's key is the line without ASCII blanks at both ends, A-Z lower-cased.  Keys of at least ten code
    points that two different ids hold keep their lines only under the smallest id.  Adds (or replaces) the
    columns n_lines, n_dropped; text_col holds the lines left, joined by newlines.

    Nulls: a null text is one empty line and becomes the empty text; rows with a null id neither lose lines nor
    make others lose theirs.  Repeated rows of one id count as one document and lose the same lines.  Very long
    texts are read whole.  Empty input: no rows.  Other columns pass through untouched, whatever they are called.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).filter("id is not null")
    lines = docs.agg(F.sum(line_breaks(F.coalesce(F.col(text_col), F.lit(""))) + 1)).first()[0] or 0
    words = min(filter_mb << 17, max(CHUNK, 1 << math.ceil(math.log2(lines / 4 + 1))))
    parts = texts.mapInArrow(partition_filters(words), "chunk int, part int, at binary, once binary, twice binary")
    parts = materialize(parts, "line-filters")
    merged = merged_arrays(parts, merge_filters, "at binary, once binary, twice binary")
    twice = np.zeros(words, np.uint64)
    for r in merged.select("chunk", "at", "twice").toLocalIterator():
        twice[np.frombuffer(r["at"], np.int32) + np.int64(r["chunk"]) * CHUNK] = np.frombuffer(r["twice"], np.uint64)
    discard(parts)
    held = spark.sparkContext.broadcast(twice.tobytes())
    kind = docs.schema[id_col].dataType.simpleString()
    suspects = materialize(texts.mapInArrow(suspects_of(held, words), f"key binary, id {kind}"), "line-suspects")
    confirmed = (
        suspects.groupBy("key")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .filter("first < last")
        .drop("last")
    )
    confirmed = materialize(confirmed, "line-repeats")
    drops = lookup_join(suspects, confirmed, "key", "n").filter("id <> first")
    drops = materialize(drops.groupBy("id").agg(F.collect_set("key").alias("keys")), "line-drops")
    discard(suspects, confirmed)
    strip = F.pandas_udf(strip_lines, "kept binary, n_lines long, n_dropped long")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    text = F.col("row").getField(text_col)
    touched = F.col("id").isNotNull() & is_suspected(held, words)(text.cast("binary"))
    whole = F.coalesce(text.cast("string"), F.lit(""))
    untouched = rows.filter(~touched).select("row", F.struct(whole.alias("kept"), (line_breaks(whole) + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).alias("left"))
    stripped = rows.filter(touched).join(drops, "id", "left").select("row", strip(text.cast("binary"), F.col("keys")).alias("left"))
    stripped = stripped.select("row", F.struct(F.col("left.kept").cast("string").alias("kept"), "left.n_lines", "left.n_dropped").alias("left"))
    rows = untouched.union(stripped)
    kept = [F.col("left.kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return rows.select(*kept, "left.n_lines", "left.n_dropped")
