import random
import zlib

import numpy as np
import pytest

from corpusprep.llm import toxicity


def auc(scores, y):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def pairs(spark, n, seed):
    """Toxic: an insult together with a group's mention; either alone is clean."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w = [rng.choice(plain) for _ in range(12)]
        w += [rng.choice(["vile", "rotten"])] * insult + [rng.choice(["folk", "clan"])] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_pairwise_interactions(shipped):
    docs, labels = pairs(shipped, 2500, 1)
    got = toxicity.toxicity_report(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95
    m = toxicity.train(docs, labels)
    z = lambda *w: m.score(toxicity.terms(" ".join(w).encode()))
    assert z("vile") < 0.5 and z("clan") < 0.5 and z("vile", "clan") > 0.5


def test_pairs_whose_parts_say_nothing_among_20000_words(shipped):
    """Each word of a pair is as common in toxic texts as in others: only the pair tells."""
    rng = random.Random(5)
    plain = ["q" + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(20_000)]
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w = [rng.choice(plain) for _ in range(12)]
        w += [rng.choice(["vile", "rotten"] if insult else ["good", "kind"]), rng.choice(["folk", "clan"] if group else ["team", "crew"])]
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(insult == group)))
    assert len({w for _, t in rows for w in t.split()}) > 15_000
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    known = shipped.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_report(docs, known).toPandas().merge(known.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95


def test_labels_dealt_at_random_leave_few_weights():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 5000, 40)) for _ in range(1500)]
    y = (rng.random(1500) < 0.3).astype(float)
    _, w, v = toxicity._fit(rows, y, 5000)
    assert (w != 0).mean() < 0.05 and np.abs(v).max() < 0.01


def test_held_out_quality_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity_report(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    m = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert auc(m.score.to_numpy(), m.toxic.to_numpy()) > 0.97
    assert m[m.toxic == 1].predicted.mean() > 0.75 and m[m.toxic == 0].predicted.mean() < 0.01


def test_held_out_labels_and_metadata_never_count(shipped):
    docs, labels = pairs(shipped, 600, 2)
    held = toxicity.held_out("doc_id")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.col("doc_id").cast("string")).repartition(7)
    a = {r.doc_id: r.score for r in toxicity.toxicity_report(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity_report(other, turned).collect()}
    assert a == pytest.approx(b, abs=1e-12)


def test_the_formula():
    rng = np.random.default_rng(0)
    sel = np.array([3, 7, 9, 20])
    m = toxicity.Machine(sel, 0.3, rng.normal(size=4), rng.normal(size=(4, toxicity.FACTORS)))
    z = 0.3 + m.w[0] + m.w[2] + m.w[3] + m.v[0] @ m.v[2] + m.v[0] @ m.v[3] + m.v[2] @ m.v[3]
    assert m.score(np.array([3, 5, 9, 20, 400])) == pytest.approx(1 / (1 + np.exp(-z)))


def test_sample_is_bounded(shipped):
    docs, labels = pairs(shipped, 3000, 3)
    n = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", sample_rows=200).count()
    assert 140 < n < 270


def test_edge_cases(tricky, tricky_rows, shipped, empty):
    labels = shipped.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (None, 1), (5, 0), (5, 1), (12345, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_report(tricky, labels).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in tricky_rows), key=str)
    by = {r.doc_id: r.score for r in got}
    assert by[90] == by[91] == by[92] == by[99]  # no terms
    assert all(0 <= r.score <= 1 for r in got)
    one_kind = shipped.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity_report(tricky, one_kind).collect()} == {0}
    none = shipped.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity_report(tricky, none).collect()} == {0}
    assert toxicity.toxicity_report(empty, labels).count() == 0
    clash = shipped.createDataFrame([(1, "a", 5, "l")], "doc_id long, text string, score int, label string")
    assert toxicity.toxicity_report(clash, labels).count() == 1
