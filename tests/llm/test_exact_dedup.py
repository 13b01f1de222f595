import hashlib
import uuid

from aerometer.llm import exact_dedup
from aerometer.llm.exact_dedup import DigestIndex
from tests.llm.helpers import documents

ROWS = [(1, "a"), (5, "a"), (3, "a"), (2, None), (4, ""), (6, "A"), (7, "a "), (8, "long " * 20000), (9, "long " * 20000),
        (5, "a"), (None, "n"), (None, "n"), (None, "A"), (10, "é"), (11, "é")]


def new_index(spark, **options):
    return DigestIndex(spark, f"digests_{uuid.uuid4().hex}", **options)


def plain(rows, earlier=None):
    groups, out, done = {}, [], set()
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for i, t in rows:
        t = t or ""
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids) if ids else None
        old = earlier is not None and t in earlier
        keep = earlier[t] if old else keep
        stays = not old and i == keep and t not in done
        if stays:
            done.add(t)
        out.append((i, keep, len(groups[t]), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_labels(spark):
    assert sorted(map(tuple, exact_dedup.label(documents(spark, ROWS)).collect()), key=repr) == plain(ROWS)


def test_second_batch_meets_the_index(spark):
    index = new_index(spark)
    first = index.label(documents(spark, ROWS)).collect()
    more = [(20, "a"), (21, "new"), (22, "new"), (23, "")]
    assert sorted(map(tuple, index.label(documents(spark, more)).collect()), key=repr) == plain(more, {"a": 5, "": 4})
    assert index.entries().count() == len({r.text_sha256 for r in first}) + 1
    assert index.label(documents(spark, [])).collect() == []


def test_rows_that_stay(spark):
    docs = documents(spark, ROWS)
    kept = exact_dedup.keep_new(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, [
        (5, "a"), (4, ""), (6, "A"), (7, "a "), (9, "long " * 20000), (None, "n"), (10, "é"), (11, "é")]))


def test_index_is_bucketed_and_not_shuffled_again(spark):
    index = new_index(spark)
    index.label(documents(spark, ROWS)).collect()
    new = documents(spark, ROWS).selectExpr("sha2(text, 256) AS text_sha256", "doc_id AS keep_id").distinct()
    plan = new.join(index.entries().hint("merge"), "text_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_buckets_follow_the_digests(spark, monkeypatch):
    assert [exact_dedup.buckets_for(n) for n in (0, 16 << 20, (16 << 20) + 1, 10 ** 10)] == [16, 16, 32, 16384]
    monkeypatch.setattr(exact_dedup, "BUCKETS", 1)
    monkeypatch.setattr(exact_dedup, "PER_BUCKET", 3)
    index = new_index(spark)
    index.label(documents(spark, ROWS)).collect()
    assert index.buckets() == 4
    # opened again it keeps the table's number, whatever the batch
    again = DigestIndex(spark, index.table, expected=1000)
    again.label(documents(spark, [(i, f"new {i}") for i in range(60)])).collect()
    assert again.buckets() == 4 and again.entries().count() == 68
    wide = new_index(spark, expected=40)
    wide.label(documents(spark, ROWS)).collect()
    assert wide.buckets() == 16


def test_one_batch_leaves_no_name(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert exact_dedup.label(documents(spark, ROWS)).count() == len(ROWS)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert exact_dedup.label(documents(spark, [])).collect() == []
