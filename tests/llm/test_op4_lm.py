import math
import zlib
from collections import Counter

import pytest

from corpusprep.llm import lm


def words_of(text):
    return (text or "").encode().lower().split() + [b"</s>"]


def brute(rows, order):
    """(id, text) rows -> sorted result rows, by plain dictionaries."""
    texts = [words_of(t) for _, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    counts = [Counter() for _ in range(order + 1)]
    for w, t in zip(texts, train, strict=True):
        if t:
            s = ["^", *w]
            counts[1].update(s)
            for n in range(2, order + 1):
                counts[n].update(tuple(s[k:k + n]) for k in range(len(s) - n + 1))
    starts = counts[1].pop("^", 0)
    tokens, types = sum(counts[1].values()), len(counts[1])
    lam = {n: min(0.95, max(0.05, sum(v == 1 for v in counts[n].values()) / max(1, sum(counts[n].values())))) for n in range(2, order + 1)}

    def prob(s, k):
        p = (counts[1][s[k]] + 1) / (tokens + types + 1)
        for n in range(2, order + 1):
            if k - n + 1 < 0:
                break
            h = tuple(s[k - n + 1:k])
            c = (starts if h == ("^",) else counts[1][h[0]]) if n == 2 else counts[n - 1][h]
            if not c:
                break
            p = (1 - lam[n]) * counts[n][(*h, s[k])] / c + lam[n] * p
        return p
    out = []
    for (i, _), w, t in zip(rows, texts, train, strict=True):
        s = ["^", *w]
        base = sum(math.log10((counts[1][x] + 1) / (tokens + types + 1)) for x in w)
        out.append((i, not t, len(w), sum(counts[1][x] > 0 for x in w), tokens, base, sum(math.log10(prob(s, k)) for k in range(1, len(s)))))
    return sorted(out, key=str), prob, counts, tokens, types


def same(got, want):
    got = sorted((tuple(r) for r in got), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[5], 3), round(r[6], 3))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order, block_bytes", [(2, 1 << 30), (2, 20_000), (3, 40_000), (1, 40_000)])
def test_tricky_rows_against_dictionaries(tricky, tricky_rows, order, block_bytes):
    want = brute([r[:2] for r in tricky_rows], order)[0]
    same(lm.score_documents(tricky, order=order, block_bytes=block_bytes).collect(), want)


def test_early_flushes_change_nothing(tricky, tricky_rows, monkeypatch):
    want = brute([r[:2] for r in tricky_rows], 2)[0]
    monkeypatch.setattr(lm, "FLUSH_TOKENS", 500)
    same(lm.score_documents(tricky, block_bytes=30_000).collect(), want)


def test_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.score_documents(docs).where("held_out").collect()
    assert len(rows) > 80
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    rows = [(1, "a b a c"), (3, "a b"), (4, "c c c b")]
    _, prob, counts, *_ = brute(rows, 2)
    for context in ("^", b"a", b"b", b"c"):
        total = sum(prob([context, w], 1) for w in [*counts[1], b"unseen"])
        assert total == pytest.approx(1)


def test_no_training_documents_and_empty(shipped, empty):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    df = shipped.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert [tuple(r)[1:] for r in lm.score_documents(df).collect()] == [(True, 3, 0, 0, 0.0, 0.0)] * 3
    assert lm.score_documents(empty).count() == 0
    learned = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2)
    clash = shipped.createDataFrame([(learned, "a b", 4, "x")], "doc_id long, text string, block int, score string")
    assert lm.score_documents(clash).first().n_known == 3
