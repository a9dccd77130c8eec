import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.llm import spelling as sp

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, every=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % every == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def brute(rows, every=31):
    n = brute_words(rows, every)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(((-n[v], v) for v in vs), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def pairs_of(spark, words, long):
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    return sorted(tuple(r) for r in sp.near_words(df, long).collect())


def brute_pairs(words):
    return sorted((a, b) for a in words for b in words if one_edit(a, b))


@pytest.mark.parametrize(("long", "letters"), [(48, "ab"), (48, "abcé"), (9, "ab"), (11, "aé"), (1, "abc")])
def test_pairs_of_crowded_words(shipped, long, letters):
    """Few letters: nodes with many words, doubled letters, every kind of edit, both halves;
    a low limit sends words past it through deletions."""
    rng = random.Random(len(letters) * 100 + long)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(7, 14))) for _ in range(220)})
    assert pairs_of(shipped, words, long) == brute_pairs(words)


def test_pairs_of_prose_words(shipped):
    rng = random.Random(4)
    parts = ["ver", "tion", "schön", "ment", "ung", "ing", "el", "a", "est"]
    words = {"".join(rng.choice(parts) for _ in range(rng.randrange(2, 5))) for _ in range(150)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + "q" + w[i:], w[:i] + "x" + w[i + 1:], w + "s", "z" + w}
    words = sorted(w for w in words if len(w) >= 7)
    assert pairs_of(shipped, words, 48) == brute_pairs(words)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeéÿ", min_size=1, max_size=80))
def test_deletions_by_rolling_hash(word):
    """A deletion has the hash of the string it leaves."""
    left = {word} | {word[:i] + word[i + 1:] for i in range(len(word))}
    whole = {s: sp._whole_hash(s) for s in left}
    assert len(set(whole.values())) == len(left)
    assert set(sp._deletions(word).tolist()) == set(whole.values())


def corpus(seed=3):
    rng = random.Random(seed)
    base = ["wonderful", "collector", "Größenwahn", "hirondelle", "abcdefgh", "element", "short", "ABCDEFGH"]
    typo = lambda w: w[:2] + w[3:] if rng.random() < 0.5 else w[:3] + "x" + w[3:]
    return [(i, " ".join(typo(w) if rng.random() < 0.05 else w for w in (rng.choice(base) for _ in range(30)))) for i in range(80)]


@pytest.mark.parametrize("every", [31, 3])
def test_against_plain_python(shipped, every):
    rows = [*corpus(), (None, "wonderful wonderfull " * 3), (7, "a" * 100 + " " + "a" * 101 + " " + "a" * 99 + "b"), (8, "a" * 100 + " " + "a" * 101 + " " + "a" * 99 + "b")]
    df = shipped.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, every)
    assert rows_of(sp.spelling_variants(df, delete_every=every)) == want
    assert any(w[1] for w in want)


def test_forms_are_followed_to_the_last(shipped):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    rows = [(None, " ".join([w] * 2 * 10 ** k)) for k, w in enumerate(chain)]
    got = rows_of(sp.spelling_variants(shipped.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert {r[2] for r in got} == {"aaaabbb"}


def test_tricky(tricky, tricky_rows):
    want = brute([(r[0], r[1]) for r in tricky_rows])
    assert rows_of(sp.spelling_variants(tricky)) == want
    assert rows_of(sp.spelling_variants(tricky.selectExpr("*", "1 as n", "'q' as word", "2 as depth", "3 as node"))) == want


def test_a_very_long_run(shipped):
    run = "abcdefghij" * 2000
    rows = [(None, f"{run} {run} {run}k {run}k {run[:9999]}z{run[10000:]}"), (None, f"{run[:9999]}z{run[10000:]}")]
    assert rows_of(sp.spelling_variants(shipped.createDataFrame(rows, "doc_id long, text string"))) == \
        sorted([(w, None, w, 2, n, None) for w, n in ((run, 2), (run + "k", 1), (run[:9999] + "z" + run[10000:], 1))])


def test_empty(empty):
    assert rows_of(sp.spelling_variants(empty)) == []


def test_nodes_with_one_word_are_not_stored(shipped):
    df = shipped.createDataFrame([("wonderful",), ("wonderfxl",), ("collector",)], "word string")
    got = {(r.dir, r.node) for r in sp.edge_table(df).collect()}
    assert got == {(0, "wond"), (0, "wonde"), (0, "wonder"), (0, "wonderf")}  # each half of a word is in one trie
    assert sp.edge_table(df).where(F.size("kids") > 30).count() == 0
