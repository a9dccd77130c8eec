import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import collocations as co
from corpusprep.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def brute(rows, least, keep=2000):
    """Rows (text, lang) -> the result as tuples, by plain counting."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in split(text):
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in cand.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    held[p[i:i + s]] = max(held[p[i:i + s]], a)
        best = []
        for p, a in cand.items():
            if 100 * held[p] >= 80 * a:
                continue
            score, _, left, right = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed=1, docs=120):
    rng = random.Random(seed)
    words = ["the", "New", "york", "of", "Größe", "été", "a\x01", "日本", "x", "état"]
    marks = [" ", "  ", "\t", ", ", ". ", "\n", " - "]
    return [("".join(rng.choice(words) + rng.choice(marks[:3] * 4 + marks) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "en", "de", None])) for _ in range(docs)]


@pytest.mark.parametrize(("least", "ranges", "bits", "block"), [(2, 7, 20, 1 << 24), (5, 50, 6, 300), (3, 1, 10, 1)])
def test_against_plain_counting(shipped, monkeypatch, least, ranges, bits, block):
    """Many ranges cut the open phrases; a filter of 64 bits is full; blocks of one text."""
    monkeypatch.setattr(co, "BLOCK_BYTES", block)
    rows = corpus()
    df = shipped.createDataFrame(rows, "text string, lang string").repartition(4)
    assert rows_of(co.mine_collocations(df, least=least, filter_bits=bits, ranges=ranges)) == brute(rows, least)


def test_keeps_the_best_of_each_language(shipped):
    rows = corpus(2)
    df = shipped.createDataFrame(rows, "text string, lang string")
    assert rows_of(co.mine_collocations(df, least=2, keep=9, filter_bits=12)) == brute(rows, 2, 9)


def test_passes_read_off_every_count(shipped):
    """Left and extension counts of the prefix order, whatever the ranges."""
    rows = corpus(3, 60)
    df = shipped.createDataFrame(rows, "text string, lang string")
    grams, _ = co.frequent_phrases(df, least=3, filter_bits=12)
    held = {(r.lang, tuple(r.words)): r.f for r in grams.collect()}
    for ranges in (1, 3, 40):
        got = co.stream_pass(grams, ranges=ranges).collect()
        ext = Counter()
        for r in got:
            key = (r.lang, tuple(r.words))
            if r.ext is not None:
                ext[key] = max(ext[key], r.ext)
            else:
                assert r.f == held[key]
                assert [r.b1, r.b2, r.b3][:len(r.words) - 1] == [held[r.lang, tuple(r.words[:k])] for k in range(1, len(r.words))]
        want = Counter()
        for (lang, p), f in held.items():
            if len(p) > 1:
                want[lang, p[:-1]] = max(want[lang, p[:-1]], f)
        assert ext == want


def test_tricky(tricky, tricky_rows):
    want = brute([(r[1], r[2]) for r in tricky_rows], 4)
    assert rows_of(co.mine_collocations(tricky, least=4, filter_bits=16)) == want
    clashing = tricky.selectExpr("*", "1 as f", "'q' as words", "2 as part", "3 as kind")
    assert rows_of(co.mine_collocations(clashing, least=4, filter_bits=16)) == want


def test_empty(empty):
    assert rows_of(co.mine_collocations(empty)) == []


def test_large_counts_are_exact(shipped):
    """Scores of counts whose products pass 64 bits."""
    big = 9_000_000_000_000
    df = shipped.createDataFrame([(big, big + 1, 2 * big)], "f long, l long, r long")
    from pyspark.sql import functions as F
    got = df.select(F.call_function("div", co._exact(F.col("f")) * F.lit(2000000).cast("decimal(7,0)"), co._exact(F.col("l")) + co._exact(F.col("r"))).alias("s"))
    assert got.first().s == 2000000 * big // (3 * big + 1)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="aB .\t,é\n日\x00", max_size=12)), st.sampled_from([None, "x", "y"])), max_size=5))
def test_words_of_a_block(rows):
    block = co.Block(pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()))
    got = [(block.langs[int(a)].as_py(), block.words[int(c)].as_py().decode()) for a, c in zip(block.lang, block.code, strict=True)]
    want, joined = [], []
    for text, lang in rows:
        for piece in split(text):
            joined += [False] * bool(piece) + [True] * (len(piece) - 1)
            want += [(lang or "und", w) for w in piece]
    assert got == want
    assert block.joined.tolist() == joined[1:]


def test_query_on_the_small_table(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows_of(queries.op13_collocations(shipped, "/root/testdata/sf0.01"))
    assert got == brute([(r.text, r.lang) for r in docs.select("text", "lang").collect()], 30) != []
