import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tallyforge.llm import common
from tallyforge.llm.line_dedup import dedup_lines
from tallyforge.llm.mixing import cycle_weights, mix_sources
from tallyforge.llm.ngram_join import keep_one_of_each
from tests.llm.conftest import prose

#: Names that operators use, or used, for columns of their own.
TAKEN = "_leak _drop _drop_id _left _cut _gone _spot _weight _slot _pattern _row _more row id keys key left kept gone rows leaks words n_lines taken".split()


@pytest.fixture(scope="module")
def clashing(spark, awkward):
    return awkward.drop("n_lines").withColumns({n: F.lit(f"mine {n}") for n in TAKEN})


def test_line_dedup_keeps_columns(clashing):
    out = dedup_lines(clashing)
    assert out.columns == [c for c in clashing.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    for r in out.collect():
        assert all(r[n] == f"mine {n}" for n in TAKEN if n != "n_lines")


def test_mix_keeps_columns(clashing):
    sized = clashing.withColumns({"size": common.word_count(F.col("text")), "members": F.array("source")})
    out = mix_sources(sized, "members", "size", F.col("doc_id"), cycle_weights).rows
    assert out.columns == [c for c in sized.columns if c != "taken"] + ["taken"] and out.count() == clashing.count()
    assert all(r[n] == f"mine {n}" for r in out.collect() for n in TAKEN if n != "taken")


def test_keep_one_keeps_columns(clashing):
    out = keep_one_of_each(clashing)
    assert out.columns == clashing.columns and 0 < out.count() < clashing.count()


@pytest.mark.parametrize("name", [n for n, _ in p.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, awkward, tmp_path, name):
    spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = awkward.withColumn("n_chars", F.length("text").cast("long")).withColumns({"_gone": F.lit(1), "language": F.lit(2), "taken": F.lit(3)})
    stage = dict(p.STAGES)[name]
    for rows in (docs, docs.limit(0)):
        out = stage(spark, rows, str(tmp_path))
        assert out.columns[:5] == p.COLUMNS
        if name == "line dedup" or rows is not docs:
            assert out.count() == rows.count()
        else:
            assert out.count() < rows.count() and {r.doc_id for r in out.collect()} <= {r.doc_id for r in rows.collect()}


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        common.scratch_root(Session())
