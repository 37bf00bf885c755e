"""The stages one after the other on the smallest data set."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute

from pyspark.sql import functions as F

import corpus_pipeline as c

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(c.STAGES[:-1]):
        before = docs
        out = stage(spark, docs, SF)
        assert tuple(out.columns) == c.COLUMNS, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if name == "n-gram Jaccard join":
            known = brute.near_components({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {g for _, g in known.values()}
        if name == "quality classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in docs.collect()}
            right = [(i in kept) == (q == 1) for i, q in labels.items()]
            assert sum(right) / len(right) > 0.9
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0
    pieces = c.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_run(spark):
    assert c.run(spark, SF).count() > 0


def test_stages_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in c.STAGES:
        assert stage(spark, none, SF).collect() == []


def odd(spark):
    """Good prose with copies under null, repeated and other ids, near copies, nulls and empties."""
    text = lambda i: " ".join(f"word{(i * 7919 + k * k * 31) % 9973}" for k in range(120)) + "."
    rows = [(i, text(i)) for i in range(1, 9)] + [(3, text(3)), (None, text(4)), (20, text(4)), (None, "only here " + text(11)), (None, "only here " + text(11)), (3, text(12))]
    rows += [(30, None), (None, None), (31, ""), (31, ""), (32, text(5) + " more")]
    return spark.createDataFrame([(i, t, "en" if i else None, "s", len(t) if t else None, "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, m_topic int"), rows, text


def test_near_copies_go_by_row(spark):
    docs, rows, text = odd(spark)
    out = c.deduplicate(spark, docs, SF)
    kept = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in out.collect())
    want = [(i, text(i)) for i in range(1, 9)] + [(-1, "only here " + text(11)), (3, text(12)), (30, ""), (-1, ""), (31, ""), (31, "")]
    assert out.columns == list(c.COLUMNS) and kept == sorted(want)


def test_every_stage_takes_odd_rows(spark):
    docs, rows, _ = odd(spark)
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert tuple(out.columns) == c.COLUMNS and 0 < out.count() <= len(rows), name
    changed = c.protect(spark, docs.limit(1).withColumn("text", F.lit("call 212-555-0100")), SF).first()
    assert changed.n_chars == len(changed.text) and "212-555-0100" not in changed.text
    assert c.pack_sequences(spark, docs, SF).agg(F.sum("length")).first()[0] > len(rows)


def test_the_classifier_judges_rows_not_ids(spark):
    large = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{large}/documents.parquet").select(*c.COLUMNS), spark.read.parquet(f"{large}/labels.parquet")
    texts = docs.join(labels, "doc_id").where("text IS NOT NULL").orderBy("doc_id")
    good, bad = (texts.where(f"quality = {q}").first().text for q in (1, 0))
    new = 10**9
    more = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in ((None, good), (new, good), (new, bad), (None, bad))], "doc_id long, text string, lang string, source string, n_chars long")
    kept = c.good_rows(docs.union(more), labels).where(f"doc_id IS NULL OR doc_id = {new}").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, good), (new, good)]


def test_the_join_writes_no_texts_anew(spark, monkeypatch):
    """With ids that tell rows apart neither its tables nor its last join's shuffles hold texts."""
    from mergewright import scratch

    docs, written, plain = spark.read.parquet(f"{SF}/documents.parquet"), [], scratch.staged

    def staged(df, name):
        written.append(df.columns)
        return plain(df, name)

    monkeypatch.setattr(scratch, "staged", staged)
    monkeypatch.setattr(c, "stash", staged)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = c.deduplicate(spark, docs, SF)
        assert out.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert written and not any("text" in columns for columns in written)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
