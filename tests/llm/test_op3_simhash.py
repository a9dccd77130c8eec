import random

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import simhash
from tests_llm_brute import brute_components, brute_fingerprint


def check(df, rows, **kw):
    got = sorted((tuple(r) for r in simhash.simhash_components(df, **kw).collect()), key=str)
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps), strict=True)), key=str)
    assert got == want


def test_tricky_rows_against_brute_force(tricky, tricky_rows):
    check(tricky, tricky_rows)


def test_small_buckets_are_dealt_again(tricky, tricky_rows):
    check(tricky, tricky_rows, bucket_rows=2)


def test_many_near_fingerprints(shipped):
    """Chains and clouds of fingerprints around a few centres, fed as classes."""
    rng = random.Random(1)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(120):
            x = c
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps, key=lambda f: f * 7919 % (1 << 64)))]
    df = shipped.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in rows], "fp long, rep long")
    want = brute_components(rows)
    for bucket in (1024, 8):
        edges = simhash.simhash_links(df, bucket_rows=bucket)
        comp = {r["id"]: r["component"] for r in simhash.connected_components(edges).collect()}
        assert [comp.get(i, i) for i, _ in rows] == want


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_every_pair_within_the_radius_meets(x, bits):
    y = x
    for b in bits:
        y ^= 1 << b
    masks = simhash.covering_masks(list(range(64)), 3)
    met = [m for m in masks if x & m == y & m]
    assert met
    for m in met:  # and again, over the positions the mask left free
        free = [p for p in range(64) if not m >> p & 1]
        assert any(x & (m | s) == y & (m | s) for s in simhash.covering_masks(free, 3))


def test_one_row_of_each_group_stays(tricky, tricky_rows):
    kept = simhash.keep_representatives(tricky).collect()
    fps = [(r[0], brute_fingerprint(r[1])) for r in tricky_rows]
    want = {i for (i, _), c in zip(fps, brute_components(fps), strict=True) if i is not None and i == c}
    named = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(named) == sorted(want)
    assert sum(r.doc_id is None for r in kept) == 3
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table_and_clashing_columns(shipped, empty):
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.keep_representatives(empty).count() == 0
    df = shipped.createDataFrame([(1, "a b c", 5, "x"), (2, "a b c", 6, "y")], "doc_id long, text string, fp long, component_id string")
    assert sorted(tuple(r)[::2] for r in simhash.simhash_components(df).collect()) == [(1, 1), (2, 1)]
    assert simhash.keep_representatives(df).columns == df.columns


def test_pairs_in_full_buckets_over_few_positions(shipped):
    """Dealing stops while the free positions still span all dimensions, whatever ``bucket_rows``."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    # zero, a word three bits away, and words near zero that fill every bucket those two meet in
    for apart in ([5, 49, 53], [33, 51, 62], [38, 45, 61]):
        words = [0, sum(1 << p for p in apart), *(1 << p for p in range(64) if p not in apart)]
        df = shipped.createDataFrame([(signed(f), i) for i, f in enumerate(words)], "fp long, rep long")
        comp = {r["id"]: r["component"] for r in simhash.connected_components(simhash.simhash_links(df, bucket_rows=2)).collect()}
        assert [comp.get(i) for i in range(len(words))] == [0] * len(words), apart
    masks = simhash.covering_masks(list(range(64)), 3)
    for _ in range(2):
        masks = [m | s for m in masks for s in simhash.covering_masks([p for p in range(64) if not m >> p & 1], 3) if s]
    at = next(f for f in ([p for p in range(64) if not m >> p & 1] for m in masks) if len(f) == 8)
    cube = [sum(1 << p for k, p in enumerate(at) if v >> k & 1) for v in range(256)]
    df = shipped.createDataFrame([(signed(f), i) for i, f in enumerate(cube)], "fp long, rep long")
    comp = {r["id"]: r["component"] for r in simhash.connected_components(simhash.simhash_links(df, bucket_rows=2)).collect()}
    assert [comp.get(i) for i in range(256)] == [0] * 256


def test_different_texts_that_share_an_id_stay(shipped):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(300))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, a), (1, b), (2, a), (3, b), (4, c), (1, c)]
    kept = simhash.keep_representatives(shipped.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, kept)) == sorted([(1, a), (1, b), (1, c)])
