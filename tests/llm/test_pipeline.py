"""Every stage against brute force on what it was given, over the smallest tables."""

import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from aerometer.llm import packing, toxicity
from aerometer.llm.common import read
from aerometer.llm.queries import id_remainder, vocabulary
from tests.llm.helpers import crc, documents
from tests.llm.test_packing import check_packed
from tests.llm.test_simhash import plain_classes, plain_mark

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = read(spark, SF_DIR, "documents"), []
    for i, (name, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF_DIR).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((name, before, docs))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(steps):
    assert [n for n, _, _ in steps] == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing sources", "packing"]
    for _, before, after in steps[:-1]:
        assert after.dtypes == before.dtypes
        assert set(rows(after)) <= set(rows(before))


def test_toxicity_drops_what_it_rejects_and_little_else(spark, steps):
    _, before, after = steps[0]
    scored = toxicity.score(before, read(spark, SF_DIR, "labels"), id_remainder(5) == 0).collect()
    assert {r.doc_id for r in scored if not r.predicted} == {r.doc_id for r in after.collect()}
    toxic = {r.doc_id for r in read(spark, SF_DIR, "labels").where("toxic = 1").collect()}
    dropped = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    labelled = {r.doc_id for r in read(spark, SF_DIR, "labels").collect()}
    assert len((dropped & labelled) - toxic) <= 0.02 * len(labelled)
    assert len(dropped & toxic) >= 0.7 * len(toxic)


def test_exact_dedup_keeps_the_largest_id(steps):
    _, before, after = steps[1]
    best = {}
    for r in before.collect():
        best[r.text or ""] = max(r.doc_id, best.get(r.text or "", -1))
    assert sorted(best.values()) == sorted(r.doc_id for r in after.collect())


def test_near_dedup_keeps_one_of_each_component(steps):
    _, before, after = steps[2]
    given = before.collect()
    marks = {r.doc_id: plain_mark(r.text) for r in given}
    root, least = plain_classes(list(marks.values()), 2), {}
    for i, m in marks.items():
        least[root[m]] = min(i, least.get(root[m], i))
    assert sorted(least.values()) == sorted(r.doc_id for r in after.collect())


def test_mixing_keeps_all(steps):
    _, before, after = steps[3]
    assert rows(before) == rows(after)


def test_packing(steps):
    from tokenizers import Tokenizer

    from aerometer.llm.queries import vocabulary

    _, before, after = steps[4]
    check_packed(Tokenizer.from_file(vocabulary()), [(r.doc_id, r.text) for r in before.collect()], after.collect())


def test_run_gives_the_last_stage(spark, steps):
    assert rows(cp.run(spark, SF_DIR)) == rows(steps[-1][2])


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = read(spark, SF_DIR, "documents"), read(spark, SF_DIR, "labels")
    turned = labels.selectExpr("doc_id", "quality", f"CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (rows(toxicity.score(docs, x, id_remainder(5) == 0)) for x in (labels, turned))
    assert a == b and [r[1] for r in a] == [crc(r[0]) % 5 == 0 for r in a]


@pytest.mark.parametrize("segment, off", [(packing.SEGMENT, 0.1), (300, 0.05)])
def test_prefixes_of_sequences_follow_the_weights(spark, monkeypatch, segment, off):
    monkeypatch.setattr(packing, "SEGMENT", segment)
    rnd = random.Random(9)
    text = lambda i, n: " ".join(["d%d" % i, *(rnd.choice(["some", "plain", "words", "here"]) for _ in range(n))])
    data = [(i, text(i, rnd.randint(50, 900)), "big" if i % 10 else "small") for i in range(1500)]
    got = cp.pack_sequences(spark, documents(spark, data), SF_DIR).collect()
    check_packed(Tokenizer.from_file(vocabulary()), [r[:2] for r in data], got)
    source, last = {r[0]: r[2] for r in data}, max(r.sequence_id for r in got) + 1

    def small(lo, hi):
        part = [r for r in got if lo * last <= r.sequence_id < hi * last]
        return sum(r.length for r in part if source[r.doc_id] == "small") / sum(r.length for r in part)

    # sizes of 9 to 1 weigh 3 to 1, so the small source ends after two fifths
    assert abs(small(0, 0.15) - 0.25) < off + 0.03 and abs(small(0, 0.3) - 0.25) < off and small(0.65, 1) < 0.02
    assert sum(r.length for r in got) > 0.95 * 2048 * last


def test_stages_on_hard_rows(spark, tmp_path):
    """Nulls, ties, repeated rows, empty, blank and very long texts, columns named like inner ones."""
    base = [(r.doc_id, r.text, r.source) for r in read(spark, SF_DIR, "documents").where("doc_id < 60").collect()]
    hard = [(900, None, None), (901, "", None), (902, " \n", "s"), (903, "long words here " * 30_000, "s"), (904, "twin", "s"), (904, "twin", "s"),
            (904, "other twin", "s"), (None, "no id at all", "s"), (None, None, None), (905, "x", "t"), (906, "x", "t")]
    inner = ("_score", "_score_vec", "_score_raw", "_score_prob", "_score_pred", "_key", "_win_id", "mix_slot", "_size", "mark", "fold")
    plain = documents(spark, base + hard).drop("mark")
    for name in inner:
        plain = plain.withColumn(name, cp.F.lit("x"))
    docs = plain
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < len(cp.STAGES) - 1:
            assert docs.dtypes == before.dtypes and set(rows(docs)) <= set(rows(before)), name
        left = [(r.doc_id, r.text or "") for r in before.collect()]
        if name == "exact dedup":
            assert sorted(t for t in (r.text or "" for r in docs.collect())) == sorted({t for _, t in left})
        if name == "mixing sources":
            assert rows(before) == rows(docs)
    check_packed(Tokenizer.from_file(vocabulary()), [(r.doc_id, r.text) for r in before.collect()], docs.collect())


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = documents(spark, [])
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() == 0
