"""N-gram Jaccard join with prefix, length, positional and suffix filters.

Documents with equal shingle sets form a class and go on as one.  All sets are ordered by one global order, rare
shingles first: by the count in a sketch of fixed size, then by the hash; any order is right, a good one only makes
prefixes selective.  Two sets with a similarity of 0.8 share a shingle within their first n - ceil(0.8 n) + 1, so
these prefixes are joined.  A pair goes on only if

    length      neither set is larger than 1.25 times the other
    positional  what follows the shared shingle in both sets can still hold the overlap needed
    suffix      a shared shingle parts both sets at one place of the order; what stands before it in one set can only
                be what stands before it in the other, and so for what follows, and in each part only shingles of one
                of 16 hash ranges can be equal: the counts of these ranges, part by part, can hold the overlap needed

and is verified once, on the whole sets.

Components need no list of all pairs.  In each group of classes with a prefix shingle in common, a pivot, the one
with the fewest rarer shingles, is compared with all others first; once they are linked to it, only pairs from
different components are compared.  Groups with many such pairs left get further pivots, so a group of thousands of
near copies costs a small multiple of its size.  No link is lost: a pair is passed over only if its two ends are
known to be connected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.llm.common import bounded_batches, discard, lookup_join, materialize, merged_arrays
from tallyforge.llm.components import stars
from tallyforge.llm.line_dedup import CHUNK, merge_filters, or_at, spots
from tallyforge.llm.shingles import batches_of_sets, mixed, set_key

COUNTERS = 1 << 20
#: Hash ranges of the suffix filter, and a digit for each.
RANGES = 16
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
#: Groups may compare this many times their size in pairs before other pivots are taken; and at most so many pivots.
PAIRS_EACH, PIVOTS = 64, 8


def count_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, c) of each row, and the partition's sketch in chunks at its end."""
    from pyspark import TaskContext

    names = ["id", "n", "c", "chunk", "part", "counts"]
    counts, kind = np.zeros(COUNTERS, np.int64), None
    for batch, sets in batches_of_sets(batches):
        kind = batch.schema.field("id").type
        k = len(sets)
        own = np.concatenate(sets)
        np.add(counts, np.bincount((own & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS), out=counts)
        cols = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.int64())]
        cols += [pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=names)
    if kind is not None:
        part, chunks = TaskContext.get().partitionId(), COUNTERS // CHUNK
        packed = [zlib.compress(x.astype(np.uint32).tobytes(), 1) for x in counts.reshape(chunks, -1)]
        cols = [pa.nulls(chunks, kind), pa.nulls(chunks, pa.int64()), pa.nulls(chunks, pa.int64())]
        cols += [pa.array(range(chunks), pa.int32()), pa.array([part] * chunks, pa.int32()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=names)


def add_counts(rows: list[dict]) -> dict:
    total = np.zeros(CHUNK, np.uint64)
    for r in rows:
        total += np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return {"counts": zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)}


def prefix_pass(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(held.value, np.uint32)
        for _, sets in batches_of_sets(batches):
            keys, sizes, prefixes, ranges, codes = [], [], [], [], []
            for s in sets:
                n = len(s)
                if not n:
                    continue
                length = n - -(-4 * n // 5) + 1
                rank = counts[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                order = np.lexsort((s, rank))[:length]
                keys.append(set_key(s))
                sizes.append(n)
                prefixes.append(s[order].view(np.int64))
                ranges.append(np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=RANGES))
                codes.append(DIGITS[(s[order] >> np.uint64(60)).astype(np.int64)].tobytes().decode())
            at = np.r_[0, np.cumsum([len(p) for p in prefixes], dtype=np.int64)].astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            cols = [
                pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64())),
                pa.array([list(map(int, r)) for r in ranges], pa.list_(pa.int32())), pa.array(codes, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["c", "n", "prefix", "ranges", "codes"])

    return run


def key_filters(words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = [row_keys(b) for b in batches]
        index, once = or_at(*spots(np.unique(np.concatenate([np.zeros(0, np.uint64), *found])), words))
        part = TaskContext.get().partitionId()
        for chunk in np.unique(index // CHUNK):
            low, high = np.searchsorted(index, [chunk * CHUNK, (chunk + 1) * CHUNK])
            own = (index[low:high] - chunk * CHUNK).astype(np.int32)
            row = [int(chunk), part, own.tobytes(), once[low:high].tobytes(), bytes(8 * len(own))]
            cols = [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32()] + [pa.binary()] * 3)]
            yield pa.RecordBatch.from_arrays(cols, names=["chunk", "part", "at", "once", "twice"])

    return build


def row_keys(batch: pa.RecordBatch) -> np.ndarray:
    """One number for class and hash of the id."""
    c, h = (np.asarray(batch.column(x)).astype(np.int64).view(np.uint64) for x in ("c", "h"))
    return mixed(c ^ mixed(h))


def whole_sets(texts: DataFrame, wanted: DataFrame, filter_mb: int = 16) -> DataFrame:
    """(c, hs) from one more pass over the texts: of the rows in wanted (c, h, h being the id's hash), and few others.

    wanted comes as a Bloom filter of bounded size, so neither texts nor unneeded sets are shuffled.  Where rows
    share an id a class may come twice.
    """
    spark = texts.sparkSession
    n = wanted.count()
    words = min(filter_mb << 17, max(CHUNK, 1 << int(np.ceil(np.log2(n / 4 + 1)))))
    parts = materialize(wanted.mapInArrow(key_filters(words), "chunk int, part int, at binary, once binary, twice binary"), "join-filter")
    bits = np.zeros(words, np.uint64)
    for r in merged_arrays(parts, merge_filters, "at binary, once binary, twice binary").toLocalIterator():
        bits[np.frombuffer(r["at"], np.int32) + np.int64(r["chunk"]) * CHUNK] = np.frombuffer(r["once"], np.uint64)
    discard(parts)
    held = spark.sparkContext.broadcast(bits.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held.value, np.uint64)
        for batch, sets in batches_of_sets(batches):
            keys = [set_key(s) for s in sets]
            c = pa.array([k or 0 for k in keys], pa.int64())
            index, mask = spots(row_keys(pa.RecordBatch.from_arrays([c, batch.column("h")], names=["c", "h"])), words)
            hit = (table[index] & mask) == mask
            pick = [i for i, k in enumerate(keys) if hit[i] and k is not None]
            own = [sets[i].view(np.int64) for i in pick]
            at = np.r_[0, np.cumsum([len(x) for x in own], dtype=np.int64)].astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *own])
            hs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in pick], pa.int64()), hs], names=["c", "hs"])

    return texts.select(F.xxhash64("id").alias("h"), "text").mapInArrow(run, "c long, hs array<bigint>")


def lengths_fit(a: Column, b: Column) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def places_fit(n: Column, pos: Column, m: Column, qos: Column) -> Column:
    """9 * overlap >= 4 * (n + m), where the overlap is at most what is left from the shared shingle on."""
    return 9 * F.least(n - pos, m - qos) >= 4 * (n + m)


def parted_overlap(ranges: tuple[Column, Column], heads: tuple[Column, Column]) -> Column:
    """The most that two sets can have in common.

    ranges are the counts of both sets' shingles in each hash range, heads the ranges (a digit each) of those up to and
    with one shingle that they share.  Before, and after it, as many can be equal as both have of a range there.
    """
    most = F.lit(0)
    for r in range(RANGES):
        before = [F.length(h) - F.length(F.replace(h, F.lit(f"{r:x}"), F.lit(""))) for h in heads]
        most += F.least(*before) + F.least(*(F.get(x, F.lit(r)) - k for x, k in zip(ranges, before)))
    return most.cast("long")


class Join:
    """State of one join: classes with ranges, the prefix groups, whole sets, and links found so far.

    Pairs are (a, b, i, j): two classes and the places of a shingle that their prefixes share.
    """

    def __init__(self, texts: DataFrame, classes: DataFrame, sketch: bytes):
        held = texts.sparkSession.sparkContext.broadcast(sketch)
        found = texts.select("text").mapInArrow(prefix_pass(held), "c long, n long, prefix array<bigint>, ranges array<int>, codes string")
        found = found.groupBy("c").agg(*[F.first(x).alias(x) for x in ("n", "prefix", "ranges", "codes")])
        found = materialize(found, "join-prefixes")
        self.ranges = found.select("c", "n", "ranges", "codes")
        rows = found.select("c", "n", F.posexplode("prefix").alias("pos", "gram"))
        group = W.partitionBy("gram")
        rows = rows.withColumns({
            "size": F.count("*").over(group), "least": F.min("n").over(group), "pivot": F.min(F.struct("pos", "n", "c")).over(group),
        })
        rows = rows.filter("size > 1").filter(9 * (F.col("n") - F.col("pos")) >= 4 * (F.col("n") + F.col("least")))
        self.rows = materialize(rows.drop("size", "least"), "join-groups")
        wanted = classes.select("c", F.xxhash64("low").alias("h")).join(self.rows.select("c").distinct(), "c", "left_semi")
        self.sets = materialize(whole_sets(texts, wanted), "join-sets")
        self.held = [found, self.rows, self.sets]
        self.links: list[DataFrame] = []
        self.roots: DataFrame | None = None
        self.tried: list[DataFrame] = []

    def verify(self, pairs: DataFrame) -> None:
        """Add the true ones among pairs (a, b, i, j) to the links; each pair is verified once in all rounds."""
        turned = F.col("a") > F.col("b")
        ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).cast("long").alias(x) for x, y in (("a", "b"), ("b", "a"), ("i", "j"), ("j", "i"))]
        # Both places in one number, so that the minimum stays in a hash table.
        pairs = pairs.select(*ends).groupBy("a", "b").agg(F.min(F.shiftleft("i", 31).bitwiseOR(F.col("j"))).alias("at"))
        for done in self.tried:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        places = (F.shiftright("at", 31), F.col("at").bitwiseAND((1 << 31) - 1))
        for end, place in zip(("a", "b"), places):
            own = self.ranges.select(F.col("c").alias(end), *[F.col(x).alias(f"{x}_{end}") for x in ("n", "ranges", "codes")])
            head = F.substring(F.col(f"codes_{end}"), F.lit(1), place.cast("int") + 1).alias(f"head_{end}")
            pairs = pairs.join(own, end).select(*pairs.columns, f"n_{end}", f"ranges_{end}", head)
        n, m = F.col("n_a"), F.col("n_b")
        most = parted_overlap((F.col("ranges_a"), F.col("ranges_b")), (F.col("head_a"), F.col("head_b")))
        pairs = pairs.filter(lengths_fit(n, m) & (9 * most >= 4 * (n + m))).select("a", "b", "n_a", "n_b")
        pairs = materialize(pairs, "join-pairs")
        self.held.append(pairs)
        self.tried.append(pairs.select("a", "b"))
        full = pairs
        for end in ("a", "b"):
            full = full.join(self.sets.select(F.col("c").alias(end), F.col("hs").alias(f"hs_{end}")), end)
        full = full.withColumn("both", F.size(F.array_intersect("hs_a", "hs_b")).cast("long"))
        full = full.filter(9 * F.col("both") >= 4 * (n + m)).select("a", "b", "both", "n_a", "n_b").distinct()
        self.links.append(materialize(full, "join-links"))

    def connect(self) -> DataFrame:
        """(node, root) of all components, those known joined by the newest links."""
        new = self.links[-1].select("a", "b")
        if self.roots is None:
            self.roots = stars(new)
        elif not new.isEmpty():
            for end in ("a", "b"):
                own = self.roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
                new = new.join(own, end, "left").withColumn(end, F.coalesce(f"root_{end}", end)).select("a", "b")
            more = stars(new)
            moved = more.select(F.col("node").alias("root"), F.col("root").alias("_root"))
            roots = self.roots.join(moved, "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
            self.roots = materialize(roots.unionByName(more), "join-roots")
        return self.roots

    def close(self) -> None:
        discard(*self.held)

    def all_links(self) -> DataFrame:
        out = self.links[0]
        for x in self.links[1:]:
            out = out.unionByName(x)
        return out

    def pivots(self) -> None:
        p = F.col("pivot")
        rows = self.rows.filter(lengths_fit(F.col("n"), p["n"]) & places_fit(F.col("n"), F.col("pos"), p["n"], p["pos"]))
        self.verify(rows.filter(F.col("c") != p["c"]).select(p["c"].alias("a"), F.col("c").alias("b"), p["pos"].alias("i"), F.col("pos").alias("j")))

    def labelled(self, rows: DataFrame, roots: DataFrame) -> DataFrame:
        rows = rows.join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
        return rows.withColumn("root", F.coalesce("root", "c"))

    def cross_pairs(self) -> DataFrame:
        """Pairs that share a prefix shingle and lie in different components, after as many pivots as needed."""
        rows = self.rows.select("gram", "c", "n", "pos")
        for turn in range(PIVOTS + 1):
            own = materialize(self.labelled(rows, self.connect()), "join-rows")
            self.held.append(own)
            by = own.groupBy("gram", "root").agg(F.count("*").alias("k"))
            groups = by.groupBy("gram").agg(F.sum("k").alias("size"), F.sum(F.col("k") * F.col("k")).alias("square"), F.count("*").alias("roots"), F.max_by("root", "k").alias("major"))
            groups = materialize(groups.filter("roots > 1"), "join-open")
            self.held.append(groups)
            rows = own.join(groups.select("gram"), "gram")
            heavy = groups.filter((F.col("size") * F.col("size") - F.col("square")) / 2 > PAIRS_EACH * F.col("size")).select("gram", "major")
            if turn == PIVOTS or heavy.isEmpty():
                break
            hard = rows.join(heavy, "gram")
            if self.passing(hard) <= PAIRS_EACH * hard.count():
                break
            chosen = hard.filter("root <> major").groupBy("gram").agg(F.min(F.struct("pos", "n", "c", "root")).alias("p"))
            pairs = hard.join(chosen, "gram").filter("root <> p.root")
            pairs = pairs.filter(lengths_fit(F.col("n"), F.col("p.n")) & places_fit(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos")))
            self.verify(pairs.select(F.col("p.c").alias("a"), F.col("c").alias("b"), F.col("p.pos").alias("i"), F.col("pos").alias("j")))
            done = chosen.select("gram", F.col("p.c").alias("c"))
            rows = rows.join(done, ["gram", "c"], "left_anti").select("gram", "c", "n", "pos")
        return self.paired(rows, cross=True)

    def passing(self, rows: DataFrame) -> int:
        """How many pairs from different components pass the filters, counted without making them.

        Rows of a component with one length and place stand together, so this takes much less than comparing all.
        """
        by = rows.groupBy("gram", "root", "n", "pos").agg(F.count("*").alias("k"))
        a, b = (by.select("gram", *(F.col(x).alias(f"{x}_{end}") for x in ("root", "n", "pos", "k"))) for end in "ab")
        fits = (F.col("root_a") < F.col("root_b")) & lengths_fit(F.col("n_a"), F.col("n_b")) & places_fit(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))
        joined = a.alias("l").join(b.alias("r"), (F.col("l.gram") == F.col("r.gram")) & fits)
        return joined.agg(F.sum(F.col("k_a") * F.col("k_b"))).first()[0] or 0

    def paired(self, rows: DataFrame, cross: bool = False) -> DataFrame:
        left = rows.select("gram", *(F.col(x).alias(f"{x}_a") for x in rows.columns if x != "gram"))
        right = rows.select("gram", *(F.col(x).alias(f"{x}_b") for x in rows.columns if x != "gram"))
        fits = (F.col("c_a") < F.col("c_b")) & lengths_fit(F.col("n_a"), F.col("n_b")) & places_fit(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))
        if cross:
            fits &= F.col("root_a") != F.col("root_b")
        return left.alias("l").join(right.alias("r"), (F.col("l.gram") == F.col("r.gram")) & fits).select(
            F.col("c_a").alias("a"), F.col("c_b").alias("b"), F.col("pos_a").alias("i"), F.col("pos_b").alias("j")
        )


def classes_of(rows: DataFrame) -> DataFrame:
    """(c, low, n_copies): the smallest id and the rows of each class."""
    return rows.filter("c is not null").groupBy("c").agg(F.min("id").alias("low"), F.count("*").alias("n_copies"))


def prepared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, bytes]:
    """The texts, (id, n, c) of each row, and the sketch of all shingles."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = materialize(texts.mapInArrow(count_pass, f"id {kind}, n long, c long, chunk int, part int, counts binary"), "join-counts", "zstd")
    parts = merged_arrays(found.filter("chunk is not null").select("chunk", "part", "counts"), add_counts, "counts binary")
    counts = np.zeros(COUNTERS, np.uint32)
    for r in parts.toLocalIterator():
        counts[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return texts, found.filter("chunk is null").select("id", "n", "c"), counts.tobytes()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, n_copies) for every row of docs.

    Two rows link when the Jaccard similarity of their sets of five-word shingles (A-Z lower-cased, words between
    ASCII blanks) is 0.8 or more; component_id is the smallest id that links reach, n_copies the rows with an equal
    set.

    Nulls and wordless texts have the empty set, link with nothing and are their own component; one to four words
    are one shingle.  A row with a null id has its component's id, null if no row with an id is in it.  Repeated
    rows are copies of each other.  No rows give no rows; other columns are ignored.
    """
    texts, rows, sketch = prepared(docs, id_col, text_col)
    classes = materialize(classes_of(rows), "join-classes")
    join = Join(texts, classes, sketch)
    join.pivots()
    join.verify(join.cross_pairs())
    roots = join.connect()
    join.close()
    classes = join.labelled(classes, roots)
    low = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = lookup_join(classes, low.withColumn("weight", F.lit(1)), "root", "weight").withColumn("weight", F.col("n_copies"))
    classes = materialize(classes.select("c", "component_id", "n_copies", "weight"), "join-components")
    linked = lookup_join(rows.filter("c is not null"), classes, "c", "weight").select("id", "n", "component_id", "n_copies")
    alone = rows.filter("c is null").select("id", "n", F.col("id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_copies")


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link between different sets as (a, b, similarity), and membership (id_col, c) of rows in sets.

    Its output may grow with the square of a group of near copies; similar_groups doesn't.
    """
    texts, rows, sketch = prepared(docs, id_col, text_col)
    join = Join(texts, materialize(classes_of(rows), "join-classes"), sketch)
    join.verify(join.paired(join.rows.select("gram", "c", "n", "pos")))
    both = F.col("both")
    links = join.all_links().select("a", "b", (both / (F.col("n_a") + F.col("n_b") - both)).alias("similarity"))
    return links, rows.select(F.col("id").alias(id_col), "c")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that link, directly or by others, to one with a smaller id.

    Rows without an id stay; of repeated rows of one id all stay or go.
    """
    groups = similar_groups(docs, id_col, text_col)
    gone = groups.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("id")).distinct()
    return docs.alias("rows").join(gone.alias("gone"), F.col(f"rows.`{id_col}`") == F.col("gone.id"), "left_anti")
