import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusprep.llm import pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute_pieces(name, text, tokenizer, capacity):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(name, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]


def check_sequences(rows, capacity):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def first_fit_decreasing(lengths, capacity):
    """Sequences that first-fit decreasing takes: a yardstick."""
    bins = []
    for length in sorted(lengths, reverse=True):
        for i, room in enumerate(bins):
            if room >= length:
                bins[i] -= length
                break
        else:
            bins.append(capacity - length)
    return len(bins)


def test_tricky_rows_against_the_tokenizer(tricky, tricky_rows, tokenizer):
    rows = pack.pack_documents(tricky, PATH).collect()
    want = sorted((p for r in tricky_rows for p in brute_pieces(r[0], r[1], tokenizer, 2048)), key=str)
    assert sorted((tuple(r)[:5] for r in rows), key=str) == want
    assert check_sequences(rows, 2048) <= first_fit_decreasing([r.length for r in rows], 2048)


def test_documents_pack_close_to_the_bound(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack.pack_documents(docs, PATH).collect()
    want = sorted(p for r in docs.collect() for p in brute_pieces(r.doc_id, r.text, tokenizer, 2048))
    assert sorted(tuple(r)[:5] for r in rows) == want
    assert check_sequences(rows, 2048) <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_small_capacity_and_ids(shipped, tokenizer):
    df = shipped.createDataFrame([(1, "alpha beta gamma delta " * 9), (2, "x"), (2, "x"), (None, "")], "doc_id long, text string")
    rows = pack.pack_documents(df, PATH, capacity=16, end_id=7, with_ids=True).collect()
    check_sequences(rows, 16)
    ids = [i for r in sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.piece) for i in r.ids]
    assert ids == [*tokenizer.encode("alpha beta gamma delta " * 9, add_special_tokens=False).ids, 7]
    full = [r.length for r in rows if r.piece > 0]
    assert set(full) == {16}


def test_special_token_text_follows_the_library(shipped, tokenizer):
    texts = ["<|endoftext|>", "a<|endoftext|>b", "<|endoftext| >", "Don't  stop\n\n\tnow 12345  x y", "\U0001f468‍\U0001f469 ́e"]
    df = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in pack.token_pieces(df, PATH).collect())
    assert got == sorted(p for i, t in enumerate(texts) for p in brute_pieces(i, t, tokenizer, 2048))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_fast_path_equals_the_library(text):
    assert list(pack._encoder(PATH)(text)) == Tokenizer_ids(text)


_T = Tokenizer.from_file(PATH)


def Tokenizer_ids(text):
    return _T.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_solver_holds_exactly_the_histogram(hist):
    plan = pack.solve(hist, 64)
    held = Counter()
    for config, copies in plan:
        assert sum(config) <= 64 and copies > 0
        for length in config:
            held[length] += copies
    assert held == Counter(hist)
    bound = -(-sum(k * v for k, v in hist.items()) // 64)
    used = sum(c for _, c in plan)
    assert bound <= used <= first_fit_decreasing(held.elements(), 64) + 1


def test_solver_at_scale_does_not_grow_with_counts():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(6.5, 0.8, 40000).astype(int), 1, 2048)
    hist = Counter(lengths.tolist())
    for factor in (1, 1000):
        plan = pack.solve({k: v * factor for k, v in hist.items()})
        used = sum(c for _, c in plan)
        bound = -(-int(lengths.sum()) * factor // 2048)
        assert used <= 1.003 * bound + 1
        assert len(plan) < 60000


def test_solver_with_uneven_counts():
    """Counts from 1 to 10**9, next to each other, are all placed; twice alike."""
    rng = np.random.default_rng(8)
    hist = {int(k): int(10 ** rng.uniform(0, 9)) for k in rng.choice(np.arange(1, 257), 120, replace=False)}
    held = Counter()
    plan = pack.solve(hist, 256)
    for config, copies in plan:
        assert sum(config) <= 256 and copies > 0
        for length in config:
            held[length] += copies
    assert held == Counter(hist)
    assert plan == pack.solve(hist, 256)


def test_empty(empty):
    assert pack.pack_documents(empty, PATH).count() == 0
