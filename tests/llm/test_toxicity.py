import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm.toxicity import (
    END, FEATURES, INSULTS, NEGATIONS, REPORTS, STEM_LETTERS, TARGETS, THREATS, Lexicon, Machine, accept, choose_stems, clauses, describe, fit, fixed_words,
    grammar, score_toxicity, stem_counts, words_of,
)
from tests.llm.conftest import prose

MACHINE, LEXICON = grammar(), Lexicon(fixed_words(), {"zorb": 6.0, "quix": 2.0})


def attack(text):
    return dict(zip(FEATURES, describe(text, LEXICON, MACHINE)))["attack"]


def test_grammar_weighs_clauses():
    plain, aimed = attack("what an idiot"), attack("you are an idiot")
    assert aimed > plain > attack("you are not an idiot") > 0
    assert plain > attack("she said what an idiot")
    assert attack("i will hurt you") > attack("that may hurt") > 0
    assert attack("you there. an idiot") == plain
    assert attack("zorbling words") == 6.0 and attack("nothing here") == 0.0
    assert attack("quixly") == 2.0 > attack("not quixly") > 0 and attack("she said quixly") < 2.0  # learned stems go the same way
    assert attack("you discuss more travel, then close the path, an idiom at a distance") == 0.0
    assert describe(None, LEXICON, MACHINE) == describe("", LEXICON, MACHINE) == (0, 0, 0)
    assert list(clauses("a b. c|d")) == [["a", "b"], ["c"], ["d"]]


@pytest.mark.parametrize("plain,aimed,denied,reported,threat,idle", [
    ("what an idiot", "you are an idiot", "you are not an idiot", "she said you are an idiot", "i will hurt you", "that may hurt"),
    ("was für ein trottel", "du bist ein trottel", "du bist kein trottel", "sie sagte du bist ein trottel", "ich werde dich töten", "das kann töten"),
    ("quel crétin", "tu es un crétin", "tu n'es pas un crétin", "elle disait que tu es un crétin", "je vais te frapper", "cela peut frapper"),
    ("vaya imbécil", "tú eres un imbécil", "tú no eres un imbécil", "ella dijo que eres un imbécil", "te voy a golpear", "puede golpear"),
])
def test_every_language_aims_denies_and_reports(plain, aimed, denied, reported, threat, idle):
    assert attack(aimed) > attack(plain) > attack(denied) > 0 and attack(plain) > attack(reported) > 0
    assert attack(threat) > attack(idle) > 0
    assert attack("l'idiot") == attack("idiot") > 0


def test_no_fixed_word_has_two_classes():
    kinds = [set(words_of(lists)) for lists in (INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS)]
    assert sum(map(len, kinds)) == len(set().union(*kinds)) and all(set(k) == {"en", "de", "fr", "es"} for k in (INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS))


def test_learned_threats_count_when_they_are_aimed(spark):
    """A word that toxic rows aim at someone is learned as a threat, one that stands anywhere as an insult."""
    r, rows = random.Random(8), []
    for i in range(900):
        bad = i % 3 == 0
        said = f". i will gronk you. {prose(i, 8)} flumpy {prose(i + 1, 8)}. {prose(i, 9)}. {prose(i + 2, 9)}" if bad else ""
        rows.append((i, prose(i, 30) + said, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    assert model.lexicon.read("gronk")[0] == "THR" and model.lexicon.read("flumpy")[0] == "INS"
    score = lambda text: dict(zip(FEATURES, describe(text, model.lexicon, MACHINE)))["attack"]
    assert score("i will gronk you") > score("they never gronk") and score("i will gronk you") > 3 * score("the door may gronk")


def stems_by_hand():
    r, clean, toxic = random.Random(1), [prose(i, 40) for i in range(200)], []
    for i in range(100):
        toxic.append(f"{prose(1000 + i, 40)} trash grumbling{r.choice(['en', 'er', 'ly', 'um', 'os', 'ad', 'iv'])} wortling")
    rows = [(t, 0) for t in clean] + [(t, 1) for t in toxic]
    counts = Counter()
    words = Counter()
    for text, kind in rows:
        for w in set(w for c in clauses(text) for w in c):
            counts[w, kind] += 1
    table = {}
    low, high = STEM_LETTERS
    for w in {w for w, _ in counts}:
        for stem in [*(w[:k] for k in range(low, min(len(w), high) + 1)), w + END]:
            have = table.setdefault(stem, [0, 0, 0])
            table[stem] = [have[0] + counts[w, 0], have[1] + counts[w, 1], have[2] + 1]
            words[stem] += 1
    return rows, table


def test_stems_end_where_words_part(spark):
    rows, table = stems_by_hand()
    df = spark.createDataFrame(rows, "text string, toxic int")
    got = {r.stem: [r.clean, r.toxic, r.words] for r in stem_counts(df.repartition(9)).collect()}
    assert got == table
    told = [(s, c, t, n, (t + 0.5) / 100 / ((c + 0.5) / 200), t / 4) for s, (c, t, n) in table.items() if t >= 3 and (t + 0.5) / (c + 0.5) > 3]
    assert set(choose_stems(told)) == {"trash" + END, "wortling" + END, "grumbling"}


def flat() -> Machine:
    """The last machine alone: words weigh what they weigh, wherever they stand."""
    return accept()


def test_the_grammar_tells_what_isolated_words_cannot(spark, monkeypatch):
    """Insults in clean rows are denied or reported, in toxic rows they are meant."""
    r, rows = random.Random(3), []
    meant = ["you are an {} who not once said so", "he is an {} and never called"]
    other = ["who not once said so you are an {}", "never called and he is an {}"]  # the same words
    for i in range(600):
        bad = i % 3 == 0
        said = r.choice(meant if bad else other).format(r.choice(["idiot", "moron", "clown", "loser"]))
        rows.append((i, f"{prose(i, 30)}. {said}. {prose(9000 + i, 30)}", int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train, test = df.filter("doc_id < 400"), df.filter("doc_id >= 400")

    def right():
        out = score_toxicity(test, fit(train.drop("toxic"), train.select("doc_id", "toxic"))).select("toxic", "toxicity.score").toPandas()
        return ((out.score >= 0.5) == (out.toxic == 1)).mean()

    with_grammar = right()
    monkeypatch.setattr("tallyforge.llm.toxicity.grammar", flat)
    assert with_grammar > 0.99 and right() < 0.75


def corpus(spark, n=600):
    r, rows = random.Random(2), []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(i, 60).split()
        if bad:
            for _ in range(4):
                words[r.randrange(60)] = f"grumb{r.choice('abcdef')}{r.choice('xyz')}"
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_learns_stems_and_leaves_clean_texts_alone(spark):
    rows = corpus(spark)
    model = fit(rows.filter("doc_id < 400").drop("toxic"), rows.filter("doc_id < 400").select("doc_id", "toxic"))
    assert "grumb" in model.lexicon.stems and not any(len(s) < STEM_LETTERS[0] for s in model.lexicon.stems)
    out = score_toxicity(rows.filter("doc_id >= 400"), model).select("toxic", "toxicity.score").toPandas()
    assert ((out.score >= 0.7) == (out.toxic == 1)).mean() > 0.97
    planted = spark.createDataFrame([("you are a worthless idiot " + prose(7, 80),), (prose(8, 80),)], "text string")
    high, low = [r.score for r in score_toxicity(planted, model).select("toxicity.score").collect()]
    assert high >= 0.7 > 0.3 > low


def test_awkward_and_empty(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 0, "x"), (1, 1, "x"), (4, 0, None), (5, 1, None), (None, 1, None), (99, 1, None), (6, None, None)], "doc_id long, toxic int, text string")
    for own in (labels, labels.limit(0)):
        out = score_toxicity(awkward, fit(awkward, own))
        scores = [r[0] for r in out.select("toxicity.score").collect()]
        assert len(scores) == awkward.count() and np.all((np.array(scores) >= 0) & (np.array(scores) <= 1))
        assert out.drop("toxicity").columns == awkward.columns
    assert score_toxicity(nothing, fit(nothing, labels)).count() == 0
    same = out.filter(F.col("doc_id") == 4).select("toxicity").collect()
    assert same[0] == same[1]


def test_stems_do_not_depend_on_how_rows_are_dealt(spark):
    r, rows = random.Random(5), []
    for i in range(1500):  # one row in a hundred is toxic; "vexed" words are used there ten times as often as elsewhere
        bad, words = i % 100 == 0, prose(i, 40).split()
        if r.random() < (0.9 if bad else 0.045):
            words[r.randrange(40)] = f"vexed{r.choice('abcdefg')}"
        rows.append((i, " ".join(words), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    models, scores = [], []
    for n in (1, 200):
        df.repartition(n).select("doc_id", "text").write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/dealt-{n}")
        docs = spark.read.parquet(path)
        models.append(fit(docs, df.select("doc_id", "toxic")))
        scores.append([x[0] for x in score_toxicity(df.limit(50), models[-1]).select("toxicity.score").collect()])
    assert models[0].lexicon.words == models[1].lexicon.words and models[0].lexicon.stems == models[1].lexicon.stems and "vexed" in models[0].lexicon.stems
    assert np.allclose(*scores, atol=1e-9)
