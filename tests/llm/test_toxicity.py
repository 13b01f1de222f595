import random

from pyspark.sql import functions as F

from aerometer.llm import toxicity as tx
from tests.llm.helpers import documents


def made(n=700):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice(["ka", "lo", "mi", "nu", "pe"]) for _ in range(rnd.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rnd.randint(20, 80))], i % 5 == 1
        for _ in range(4 if toxic else 0):
            words.insert(rnd.randint(0, len(words)), rnd.choice(["idiot", "M0ron", "sc*um", "zorvan" + word(), "zorvan" + word()]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = made()
    hard = [(9001, None), (9002, ""), (9003, " \n"), (9004, "long text " * 30000), (9005, "x"), (9005, "x"), (None, "you idiot, you moron!")]
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (77777, 1)], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = tx.score(documents(spark, rows + hard), marks, held).collect()
    assert len(got) == len(rows) + len(hard)
    truth = dict(labels)
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in test) >= 0.95 * len(test)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    empty = {r.score for r in got if r.doc_id in (9001, 9002, 9003)}
    assert len(empty) == 1 and max(empty) < 0.5


def test_one_class_or_no_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in tx.score(docs, marks, F.lit(False)).collect()] == [0.0, 0.0]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r.score for r in tx.score(docs, ones, F.lit(False)).collect()] == [1.0, 1.0]
    assert tx.score(documents(spark, []), ones, F.lit(False)).collect() == []


def test_few_rows_of_a_class_give_the_rate(spark):
    docs = documents(spark, [(i, f"plain text {i}") for i in range(10)])
    marks = spark.createDataFrame([(i, int(i < 2)) for i in range(10)], "doc_id long, toxic int")
    assert {r.score for r in tx.score(docs, marks, F.lit(False)).collect()} == {0.2}


def test_folds_hold_both_classes_and_equal_texts_together(spark):
    rows = [(i, f"text {i % 40}") for i in range(80)]
    marks = spark.createDataFrame([(i, int(i % 40 < 5)) for i in range(80)], "doc_id long, toxic int")
    got = tx.training_rows(documents(spark, rows), marks, None, 7).collect()
    assert len(got) == 80
    of = {}
    for r in got:
        of.setdefault(r.text, set()).add(r.fold)
    assert all(len(f) == 1 for f in of.values())
    assert {(r.toxic, r.fold) for r in got} == {(t, k) for t in (0, 1) for k in range(tx.FOLDS)}


def test_lexicons_leave_their_fold_out(spark):
    rows = [(f"bad{i % 3}word w{i}", 1, i % 3) for i in range(30)] + [(f"w{i}", 0, i % 3) for i in range(60)]
    found = tx.learn_lexicons(spark.createDataFrame(rows, "text string, toxic int, fold int"))
    for k in range(3):
        assert f"bad{k}word" not in found[k][0] and f"bad{(k + 1) % 3}word" in found[k][0]
    assert {"bad0word", "bad1word", "bad2word"} <= set(found[3][0])


def test_calibration_is_linear_between_its_points(spark):
    model = tx.ToxicityModel([], [], None, [(0.2, 0.1), (0.4, 0.1), (0.6, 0.9)], 0.0)
    got = spark.createDataFrame([(p,) for p in (0.0, 0.2, 0.3, 0.5, 0.6, 1.0)], "p double").select(model.calibrated(F.col("p"))).collect()
    assert [round(r[0], 6) for r in got] == [0.1, 0.1, 0.1, 0.5, 0.9, 0.9]


def test_features_read_masked_words():
    names = tx.FEATURES
    of = lambda t, **k: dict(zip(names, tx.features(t, frozenset(k.get("words", ())), frozenset(k.get("stems", ())), frozenset(s[:4] for s in k.get("stems", ())))))
    for t in ("such an idiot", "such an 1d1ot", "such an id!ot", "such an idiooot", "such an i.d.i.o.t here"):
        assert of(t)["abuse_any"] == 1.0, t
    assert of("nothing of the kind")["abuse_any"] == 0.0
    assert of("zorvanka lo", stems=["zorvan"])["stem_rate"] == 0.5
    assert of("you are a moron")["near_you"] > 0 and of("moron " + "x " * 20 + "you")["near_you"] == 0
    assert of("you and the bad moron, moron you")["near_you"] == 2 / 7
    assert set(tx.features("", frozenset(), frozenset(), frozenset())) == {0.0}
    assert len(tx.features("a", frozenset(), frozenset(), frozenset())) == len(names)
