import random

from pyspark.sql import functions as F

import corpus_pipeline as p
from tallyforge.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import prose
from tests.llm.test_language_id import STEMS, text


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
    assert len(p.STAGES) == 5


def test_stages_take_effect(spark, tmp_path):
    item = prose(500, 30)
    shared = "a line that many of the documents have in common"
    rows = [(i, prose(i, 80), "en" if i % 2 else "fr", f"s{i % 3}", 0) for i in range(60)]
    rows += [(60, "12 34 !!", "en", "s0", 0), (61, None, None, None, None), (62, rows[5][1], "en", "s1", 0), (63, rows[5][1] + " tail", "en", "s1", 0)]
    rows += [(64, prose(640, 20) + " " + item, "en", "s2", 0), (65, f"{shared}\n{prose(65, 40)}", "en", "s0", 0), (66, f"{shared}\n{prose(66, 40)}", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage, ids = dict(p.STAGES), lambda df: {r.doc_id for r in df.collect()}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = stage["language ID"](spark, docs, str(tmp_path))
    assert ids(docs) - ids(kept) == {60, 61} and kept.columns == p.COLUMNS
    lines = stage["line dedup"](spark, docs, str(tmp_path))
    assert ids(lines) == ids(docs) and lines.columns == p.COLUMNS
    assert lines.filter("doc_id = 66").first().text == prose(66, 40) and lines.filter("doc_id = 65").first().text.startswith(shared)
    assert lines.filter("doc_id = 66").first().n_chars == len(prose(66, 40))
    single = stage["n-gram Jaccard join"](spark, docs, str(tmp_path))
    assert ids(docs) - ids(single) == {62, 63}
    clean = stage["benchmark decontamination"](spark, docs, str(tmp_path))
    assert ids(docs) - ids(clean) == {64}
    mix = stage["source mix"](spark, docs, str(tmp_path))
    assert mix.filter("taken <> size * repeats or taken <= 0").count() == 0 and 0 < mix.count() <= docs.count()
    out = p.run(spark, str(tmp_path))
    assert not ids(out) & {60, 61, 62, 63, 64} and out.count() == p.run(spark, str(tmp_path)).count()


def test_the_language_stage_decides(spark):
    r = random.Random(4)
    junk = ["".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(60)]
    rows = [(i, text(k, i, 10 + i % 60), k, "s", 0) for i in range(300) for k in STEMS]
    rows += [(1000, " ".join(junk), "en", "s", 0), (1001, "привет как дела сегодня " * 9, None, "s", 0), (1002, "12 34", "en", "s", 0), (1003, "the and", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(p.STAGES)["language ID"](spark, docs, "")
    assert {x.doc_id for x in docs.collect()} - {x.doc_id for x in kept.collect()} == {1000, 1001, 1002} and kept.count() == len(rows) - 3
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert dict(p.STAGES)["language ID"](spark, unlabelled, "").count() == len(rows) - 1
