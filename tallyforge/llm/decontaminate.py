"""Benchmark decontamination by SimHash windows, with DataFrame operations only.

1. Windows.  If a window has similarity L or more to an item, the item's shingles in it weigh at least L times the
   item.  So at every word position that begins a shingle of some item, the weights of such shingles are summed over
   the next item-sized window, for every size of item that has them; windows whose sum reaches L times the lightest
   item of that size are looked at.  Shingles may stand in any order and place.
2. Fingerprints.  The weighted SimHash of a window's shingles, 64 bits.  Shingles that many items share weigh less.
3. Multi-index.  Fingerprints are cut into 6 blocks.  If two of them differ in at most 17 bits, some block differs
   in at most 2, so probing each block with all values within 2 bits finds every item within the radius.
4. Verification.  Exact weighted Jaccard similarity of the shingle sets, 0.8 or more.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.llm.common import materialize

SHINGLE, LEAST = 5, 0.8
#: Bits of each block; their number and the flips allowed in one give the radius that is searched in full.
BLOCKS, FLIPS = (11, 11, 11, 11, 10, 10), 2
RADIUS = len(BLOCKS) * (FLIPS + 1) - 1
#: A table of at most so many rows of a few numbers is broadcast (about 16 MB); a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000
#: A window of m shingles spans so many steps of a position scaled by m; exact for m up to 2 ** 18.
SPAN, SLACK = 1 << 36, 1 << 17


def words_of(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, so case and punctuation hide no passage; none for null."""
    parts = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(parts, lambda word: F.xxhash64(word))


def shingles(words: Column, width: int) -> Column:
    """Hash of every run of width words, in order; none if there are fewer words."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))


def simhash(h: Column, weight: Column) -> Column:
    """Aggregate: bit b is set if the hashes that have it weigh more than the others."""
    bits = [
        F.when(F.sum(F.when(F.shiftright(h, b).bitwiseAND(1) == 1, weight).otherwise(-weight)) > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        for b in range(64)
    ]
    out = bits[0]
    for b in range(1, 64):
        out = out.bitwiseOR(F.shiftleft(bits[b], b))
    return out


def blocks(fingerprint: Column) -> Column:
    """array<struct<block, value>> of the fingerprint."""
    parts, at = [], 0
    for k, bits in enumerate(BLOCKS):
        value = F.shiftrightunsigned(fingerprint, at).bitwiseAND((1 << bits) - 1)
        parts.append(F.struct(F.lit(k).alias("block"), value.cast("int").alias("value")))
        at += bits
    return F.array(*parts)


def flips(block: Column) -> Column:
    """All masks of at most FLIPS bits for the block's width."""
    by_width = {}
    for bits in sorted(set(BLOCKS)):
        by_width[bits] = [sum(1 << b for b in c) for n in range(FLIPS + 1) for c in combinations(range(bits), n)]
    out = F.lit(None).cast("array<int>")
    for k, bits in enumerate(BLOCKS):
        out = F.when(block == k, F.array(*map(F.lit, by_width[bits]))).otherwise(out)
    return out


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = LEAST) -> DataFrame:
    """(id_col, item_col, similarity, start, n_words): a row for each document and item it holds a window of.

    similarity is that of the best window, start the (0-based) word it begins at, n_words its length.  Shingles are
    five words; an item of fewer words is one shingle.  A document shorter than an item is compared whole.

    Nulls: null or wordless texts leak nothing; null ids are reported as null, rows with a null id counting as one
    document.  Repeated rows of an id count once, and of rows of one id with different texts each is looked at.  Very
    long texts are searched whole.  Ties go to the earliest window.  Empty tables: no rows.  Other columns are ignored.

    Found are the windows whose fingerprint is within RADIUS of the item's.
    """
    items = bench.select(F.col(item_col).alias("item"), words_of(F.col(item_text)).alias("words")).filter(F.size("words") > 0)
    items = items.withColumns({"ik": F.xxhash64("words"), "n": F.size("words"), "k": F.least(F.size("words"), F.lit(SHINGLE))})
    items = materialize(items, "leak-items")
    n_rows = items.count()
    texts = items.dropDuplicates(["ik"]).drop("item")
    widths = sorted(r[0] for r in texts.select("k").distinct().collect())  # 1 to 5
    hashed = F.coalesce(*[F.when(F.col("k") == k, shingles(F.col("words"), k)) for k in widths or [SHINGLE]])
    texts = materialize(texts.withColumn("hs", F.array_distinct(hashed)).drop("words"), "leak-texts")
    placed = texts.select("ik", "n", "k", F.explode("hs").alias("h"))
    n_items, n_placed = texts.count(), placed.count()
    # Weights from how many items have a shingle; one that no item has counts as rare.
    rare = F.log(F.lit(1.0 + max(n_items, 1)))
    weights = placed.groupBy("h").agg(F.count("*").alias("df"))
    weights = materialize(weights.select("h", F.log(1 + n_items / F.col("df")).alias("w")), "leak-weights")
    weighed = placed.join(small(weights, n_placed), "h")
    lightest = weighed.groupBy("ik", "n", "k").agg(F.sum("w").alias("total")).groupBy("n", "k").agg(F.min("total").alias("lightest"))
    looked = weighed.select("h", "k", "n", "w").distinct().join(lightest, ["n", "k"])

    texts_of = F.xxhash64(F.col(text_col))  # tells apart rows of one id, and spreads those without
    docs = docs.select(F.col(id_col).alias("id"), texts_of.alias("tk"), words_of(F.col(text_col)).alias("words"))
    hits = None
    for k in widths or [SHINGLE]:
        rows = docs.select("id", "tk", F.size("words").alias("size"), F.posexplode(shingles(F.col("words"), k)).alias("p", "h"))
        rows = rows.join(small(looked.filter(F.col("k") == k), n_placed), "h").drop("h")
        hits = rows if hits is None else hits.unionByName(rows)
    scaled = F.expr(f"cast(p as bigint) * {SPAN}L div (n - k + 1)")
    reach = W.partitionBy("id", "tk", "n", "k").orderBy(scaled).rangeBetween(0, SPAN - SLACK)
    start = F.greatest(F.lit(0), F.least(F.col("p"), F.col("size") - F.col("n")))
    anchors = hits.withColumn("held", F.sum("w").over(reach)).filter(F.col("held") >= F.col("lightest") * least - 1e-6)
    anchors = materialize(anchors.select("id", "tk", start.alias("start"), "n", "k").distinct(), "leak-anchors")

    cut = F.slice("words", F.col("start") + 1, F.col("n"))
    hs = F.coalesce(*[F.when(F.col("k") == k, F.array_distinct(shingles(cut, k))) for k in widths or [SHINGLE]])
    windows = anchors.withColumnsRenamed({"id": "_id", "tk": "_tk"}).join(docs, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tk") == F.col("tk")))
    windows = windows.select("id", "start", "n", hs.alias("hs"), F.xxhash64("id", "tk", "start", "n", "k").alias("wk")).dropDuplicates(["wk"])
    windows = materialize(windows, "leak-windows")
    w = F.coalesce("w", rare)

    def prints(rows: DataFrame, key: str) -> DataFrame:
        rows = rows.select(key, F.explode("hs").alias("h")).join(small(weights, n_placed), "h", "left").withColumn("w", w)
        return rows.groupBy(key).agg(simhash(F.col("h"), F.col("w")).alias("f"), F.sum("w").alias("total"))

    probes = prints(windows, "wk").join(windows, "wk").withColumn("b", F.explode(blocks(F.col("f"))))
    probes = probes.select("*", "b.block", "b.value").drop("b")
    index = prints(texts, "ik").join(texts, "ik")
    index = index.select("ik", "n", F.col("f").alias("item_f"), F.explode(blocks(F.col("f"))).alias("b"))
    index = index.withColumn("flip", F.explode(flips(F.col("b.block"))))
    index = index.select("ik", "n", "item_f", F.col("b.block").alias("block"), F.col("b.value").bitwiseXOR(F.col("flip")).alias("value"))
    pairs = probes.join(index, ["n", "block", "value"])
    pairs = pairs.filter(F.bit_count(F.col("f").bitwiseXOR(F.col("item_f"))) <= RADIUS)
    pairs = pairs.dropDuplicates(["wk", "ik"]).select("id", "start", "n", "hs", "total", "ik")
    whole = weighed.groupBy("ik").agg(F.map_from_entries(F.collect_list(F.struct("h", "w"))).alias("item_w"), F.sum("w").alias("item_total"))
    pairs = pairs.join(small(whole, n_placed), "ik")
    common = F.aggregate(F.array_intersect("hs", F.map_keys("item_w")), F.lit(0.0), lambda acc, h: acc + F.element_at("item_w", h))
    pairs = pairs.withColumn("common", common)
    similarity = F.col("common") / (F.col("total") + F.col("item_total") - F.col("common"))
    found = pairs.withColumn("similarity", similarity).filter(F.col("similarity") >= least - 1e-9)
    best = F.max_by(F.struct("start", "n"), F.struct(F.round("similarity", 9), -F.col("start"), "n"))
    found = found.groupBy("id", "ik").agg(F.max(F.round("similarity", 9)).alias("similarity"), best.alias("at"))
    found = found.join(small(items.select("ik", "item"), n_rows), "ik")
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "similarity", F.col("at.start").alias("start"), F.col("at.n").alias("n_words")).distinct()


def drop_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that hold a benchmark item; columns as they are, whatever they are called."""
    found = find_leaks(docs, bench, id_col, text_col).select(F.col(id_col).alias("id")).distinct()
    leaks, rows = found.alias("leaks"), docs.alias("rows")
    return rows.join(leaks, F.col(f"rows.`{id_col}`").eqNullSafe(F.col("leaks.id")), "left_anti")
