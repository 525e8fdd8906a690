"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.ball_kmeans import cluster_vectors
from tallyforge.llm.common import materialize, read, word_count
from tallyforge.llm.decontaminate import find_leaks
from tallyforge.llm.html_extract import extract_main_text
from tallyforge.llm.language_id import fold, identify_languages
from tallyforge.llm.line_dedup import dedup_lines
from tallyforge.llm.mixing import cycle_weights, mix_sources
from tallyforge.llm.ngram_join import similar_groups
from tallyforge.llm.ogg import encode_texts, probe_media
from tallyforge.llm.pii import find_pii
from tallyforge.llm.secrets import ALLOWED, CANDIDATE, CANDIDATES, CLASSES, scan_secrets
from tallyforge.llm.secrets import ASSIGN as ASSIGN_PATTERN
from tallyforge.llm.toxicity import fit as fit_toxicity
from tallyforge.llm.toxicity import score_toxicity
from tallyforge.llm.warc import read_warc, write_warc
from tallyforge.llm.whitening import fit_whitening, whiten


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    mix = mix_sources(sized.withColumn("members", F.array("source")), "members", "size", F.col("doc_id"), cycle_weights)
    known = [(s, mix.source_sizes[s], float(t)) for s, t in mix.targets.items()]
    known = spark.createDataFrame(known, "s string, source_size long, target double")
    rows = mix.rows.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("s")))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
with lines as (
  select doc_id, rowid as r, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as pos
  from (select row_number() over () as rowid, doc_id, text from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (
  select k, min(doc_id) as first_doc from keyed where length(k) >= 10
  group by k having count(distinct doc_id) >= 2),
marked as (
  select doc_id, r, line, pos, coalesce(doc_id <> first_doc, false) as gone
  from keyed left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id, r
"""

def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
with recursive words as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w
  from documents),
grams as materialized (
  select distinct r, doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i : i + 4], ' ') end as g
  from words, unnest(generate_series(1, greatest(len(w) - 4, 1))) as t(i) where len(w) > 0),
sizes as materialized (select r, doc_id, count(*) as n from grams group by r, doc_id),
pairs as materialized (
  select x.r as a, y.r as b, count(*) as common
  from grams x join grams y on x.g = y.g and x.r < y.r group by x.r, y.r),
links as materialized (
  select a, b from pairs join sizes sa on sa.r = a join sizes sb on sb.r = b
  where 100 * common >= 80 * (sa.n + sb.n - common)),
edges as materialized (select a, b from links union all select b, a from links),
reach(r, o) as (
  select r, r from words union select reach.r, edges.b from reach join edges on edges.a = reach.o)
select w.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id
from words w left join sizes s on s.r = w.r
join (select reach.r, min(o.doc_id) as component_id from reach join words o on o.r = reach.o group by reach.r) l on l.r = w.r
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    training = docs.filter(fold("doc_id", 4) != 2)
    found = identify_languages(docs.select("doc_id", "text"), training)
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("language.lang").alias("lang_pred"), "language.score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold("doc_id", 3) != 1)
    model = fit_toxicity(docs, labels)
    score = F.col("toxicity.score")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held_out, score, (score >= 0.7).cast("int").alias("predicted"))


def op7_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    media = encode_texts(docs.withColumn("n_bytes", n_bytes)).drop("text")
    stored = materialize(media, "ogg-media", "zstd")
    rows = stored.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), probe_media(F.col("media")).alias("m"))
    return rows.select(
        "doc_id", "n_bytes", "m.payload_bytes", "m.payload_sha256", "m.tail_crc32", "media_bytes", "m.media_sha256",
        "m.feature", "m.seconds", "m.n_streams", "m.n_pages", "m.n_packets",
    )


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(write_warc(read(spark, sf_dir, "pages")), "warc-bundles")
    return read_warc(stored).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
f as (
  select payload_digest, min(page_id) as first_page from p
  where payload_bytes >= 100 and page_id is not null group by payload_digest)
select page_id, payload_bytes, payload_digest,
       case when page_id <> first_page then 'revisit' else 'response' end as record_type,
       case when page_id <> first_page then first_page end as refers_to
from p left join f using (payload_digest)
"""

def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", "pii.n_email", "pii.n_ip", "pii.n_card", "pii.n_phone",
        F.sha2("pii.base", 256).alias("base_sha256"), "pii.spans", "pii.n_added",
    )


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", F.sha2("secrets.base", 256).alias("base_sha256"),
        "secrets.spans", "secrets.n_entropy",
    )


def op11_sql() -> str:
    """Every window of every candidate string, its characters counted anew."""
    quoted = {name: p.replace("'", "''") for name, p in [("assign", ASSIGN_PATTERN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"), ("cand", CANDIDATES % CANDIDATE)]}

    def found(name: str) -> str:
        p = quoted[name]
        return f"""
{name}_m as materialized (
  select r, unnest(generate_series(1, len(m))) as i, unnest(m) as m,
         unnest(list_transform(g[1 : len(m)], lambda x: length(x))) as gap
  from (select r, regexp_extract_all(t, '{p}') as m, string_split_regex(t, '{p}') as g from d)),
{name}_s as materialized (
  select r, m, (sum(gap + length(m)) over (partition by r order by i) - length(m))::bigint as s from {name}_m)"""

    classes = ", ".join(f"('{c.name}', '{c.characters}', {c.width}, {c.most})" for c in CLASSES)
    allow = "|".join(f"(?:{a})" for a in ALLOWED)
    return f"""
with d as materialized (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
{found("assign")}, {found("access")}, {found("hex")}, {found("cand")},
base as materialized (
  select r, s, 0 as k, s + length(m) as e from assign_s where length(regexp_extract(m, '{quoted["assign"]}', 2)) >= 6
  union all select r, s, 1, s + length(m) from access_s where length(m) >= 20
  union all select r, s, 2, s + length(m) from hex_s where length(m) >= 24),
classes(name, chars, w, most) as (values {classes}),
letters as materialized (
  select c.r, c.m, c.s, k.name, k.w, k.most, p, m[p] as ch, instr(k.chars, m[p]) > 0 as inside
  from cand_s c, classes k, generate_series(1, length(c.m)) as t(p)),
runs as materialized (
  select *, p - row_number() over (partition by r, s, name order by p) as run from letters where inside),
ends as materialized (
  select r, s, name, run, min(p) as p0, max(p) as p1, any_value(m) as m, any_value(w) as w, any_value(most) as most
  from runs group by r, s, name, run having count(*) >= any_value(w)),
windows as (select e.*, q from ends e, generate_series(e.p0, e.p1 - e.w + 1) as t(q)),
counts as (
  select w.r, w.s, w.name, w.run, w.q, any_value(w.most) as most, count(*) as c
  from windows w, generate_series(w.q, w.q + w.w - 1) as t(p) group by w.r, w.s, w.name, w.run, w.q, w.m[p]),
high as (
  select distinct r, s, name, run from (
    select r, s, name, run, q from counts group by r, s, name, run, q
    having sum(case when c > 1 then floor(c * log2(c) * 1048576 + 0.5) else 0 end) <= any_value(most))),
kept as (
  select r, s + p0 - 1 as s, s + p1 as e from ends join high using (r, s, name, run)
  where not regexp_matches(m[p0 : p1], '{allow}')),
flagged as (
  select *, case when s < max(e) over (partition by r order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh
  from kept),
islands as (select *, sum(fresh) over (partition by r order by s, e) as island from flagged),
united as (select r, min(s) as s, max(e) as e from islands group by r, island),
entropy as materialized (
  select r, s, 3 as k, e from united u
  where not exists (select 1 from base b where b.r = u.r and b.s <= u.s and u.e <= b.e)),
spans as (
  select r, s, k, e, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || s || ':' || e as span
  from (select * from base union all select * from entropy)),
sums as (
  select r, count(*) filter (where k = 0) as a, count(*) filter (where k = 1) as b, count(*) filter (where k = 2) as c,
         count(*) filter (where k = 3) as n, string_agg(span, ',' order by s, k) as spans,
         string_agg(span, ',' order by s, k) filter (where k < 3) as base
  from spans group by r)
select doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(b, 0)::bigint as n_access, coalesce(c, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n, 0)::bigint as n_entropy
from d left join sums using (r)
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = fit_whitening(vectors, "embedding")
    rows = whiten(vectors, "embedding", fitted).select("vec_id", "whitening.deviation", F.posexplode("whitening.whitened").alias("i", "whitened"))
    shares = F.array(*[F.lit(s) for s in fitted.explained]) if fitted else F.array()
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"), "deviation", "whitened",
        shares.cast("array<double>")[F.col("i")].alias("explained"), F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"),
    )


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", "vec_id")
    total = sum(found.inertia.values())
    named = [
        (i, inertia, total, hashlib.sha256(",".join(map(str, found.centroids[i].tolist())).encode()).hexdigest())
        for i, inertia in found.inertia.items()
    ]
    named = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = found.rows.select("vec_id", F.col("cluster.number").alias("cluster"), "cluster.distance")
    return rows.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Plain Lloyd rounds, every distance computed."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
d{i} as materialized (
  select r, x, arg_min(num, (dist, num)) as num, min(dist) as dist from (
    select v.r, v.x, c.num, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as dist
    from v, c{i} c) group by r, x)""")
        if i < rounds:
            steps.append(f"""
m{i} as materialized (
  select num, list(m order by i) as x from (
    select num, i, (sum(x[i]) // count(*) - case when sum(x[i]) % count(*) < 0 then 1 else 0 end)::bigint as m
    from d{i}, generate_series(1, 64) as t(i) group by num, i) group by num),
c{i + 1} as materialized (select num, coalesce(m{i}.x, c{i}.x) as x from c{i} left join m{i} using (num))""")
    return f"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(256 * e::double)::bigint) as x
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), x) - 1 as num, x from v where vec_id is not null
  order by sha256('2:' || vec_id), x limit {k}),{",".join(steps)},
t as (select num, sum(dist)::bigint as cluster_inertia from d{rounds} group by num)
select v.vec_id, d.num::int as cluster, d.dist as distance, t.cluster_inertia,
       (select sum(dist)::bigint from d{rounds}) as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from d{rounds} d join v using (r) join t on t.num = d.num join c{rounds} c on c.num = d.num
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_line_dedup, op3_source_mix, op4_ngram_jaccard, op5_language_id, op6_toxicity, op7_ogg_media,
        op8_html_text, op9_warc_bundles, op10_pii, op11_secrets, op12_whitening, op13_ball_kmeans,
    )
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": OP2_SQL, "op4_ngram_jaccard": OP4_SQL, "op9_warc_bundles": OP9_SQL, "op11_secrets": op11_sql(), "op13_ball_kmeans": op13_sql(),
}
