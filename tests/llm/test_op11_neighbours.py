import math
import random

import numpy as np
import pytest

from corpusprep.llm import neighbours as nb
from corpusprep.llm import queries
from corpusprep.llm.embeddings import rotation

SCHEMA = "vec_id long, embedding array<float>"


def usable(i, v):
    return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k=5, every=50):
    """{query: [(rank, id, score)]} by all pairs; an id stands for one vector here."""
    rows = {(i, tuple(np.float32(v).tolist())) for i, v in rows if usable(i, v)}
    out = {}
    for i, q in rows:
        if i % every:
            continue
        found = []
        for j, v in rows:
            if j != i and len(v) == len(q):
                a, b = np.array(q), np.array(v)
                found.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 12), j))
        out[i] = [(r, j, -s) for r, (s, j) in enumerate(sorted(found)[:k], 1)]
    return {i: x for i, x in out.items() if x}


def rows_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i, x in want.items():
        assert [(r, j) for r, j, _ in got[i]] == [(r, j) for r, j, _ in x], i
        assert np.allclose([s for _, _, s in got[i]], [s for _, _, s in x], atol=1e-12)


def clustered(n, dim=24, groups=12, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    return [(i, (centre[i % groups] + 0.3 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def test_one_list_is_exact(shipped):
    rows = clustered(300)
    same(rows_of(nb.nearest_neighbours(shipped.createDataFrame(rows, SCHEMA), every=10)), brute(rows, every=10))


@pytest.mark.parametrize(("chunk", "tile"), [(1 << 22, 256), (1, 3)])
def test_lists_chunks_and_tiles(shipped, chunk, tile):
    """Several lists, chunks of 64 vectors, three queries a tile: recall against all pairs."""
    rows = clustered(1500, seed=1)
    got = rows_of(nb.nearest_neighbours(shipped.createDataFrame(rows, SCHEMA).repartition(5), every=20, one_list=100, chunk_bytes=chunk, tile=tile))
    want = brute(rows, every=20)
    hits = sum(len({j for _, j, _ in got[i]} & {j for _, j, _ in x}) for i, x in want.items())
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    assert hits >= 0.95 * 5 * len(want)


def test_probing_all_lists_without_a_test_is_exact(shipped):
    rows = clustered(800, seed=2)
    got = rows_of(nb.nearest_neighbours(shipped.createDataFrame(rows, SCHEMA), every=16, one_list=50, share=1.0, epsilon=1e6, sample_bytes=1 << 30))
    want = brute(rows, every=16)
    hits = sum(len({j for _, j, _ in got[i]} & {j for _, j, _ in x}) for i, x in want.items())
    assert hits >= 0.99 * 5 * len(want)


def test_scan_gives_candidates_up_early():
    """Less is read than all blocks, and what is left out is far."""
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(3000, 128))
    raw[:40] = raw[0] + 0.2 * rng.normal(size=(40, 128))
    unit = nb.units(raw)
    turned = (unit @ rotation(128).T).astype(np.float32)
    blocks = [np.ascontiguousarray(turned[:, i:i + nb.BLOCK]) for i in range(0, 128, nb.BLOCK)]
    q, r, c, read = nb.scan_chunk(turned[:8], unit[:8], np.full(8, 2.0), blocks, unit, np.arange(3000), 6)
    assert read < 0.5 * 8 * unit.size
    cosines = unit[:8] @ unit.T
    for i in range(8):
        want = np.lexsort((np.arange(3000), -cosines[i]))[:6]
        assert r[q == i].tolist() == want.tolist()
        assert np.allclose(c[q == i], cosines[i][want])


def test_every_vector_is_in_one_list(shipped):
    x = nb.units(np.array([v for _, v in clustered(900, seed=5)])).astype(np.float32)
    centres = nb.fit_lists(x[:400], 20)
    own = nb._nearest(x, centres)
    assert (own == np.argmax(x @ centres.T, axis=1)).all() and np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)
    model = nb.Lists({24: centres}, {24: 2})
    model.sizes[24] = np.array([1] * 19 + [0])
    assert all(len(p) == 6 and 19 not in p for p in model.probed(x[:30], 6))  # two lists hold too few


def test_tricky(shipped):
    rng = random.Random(1)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1, 120)]
    rows += [(200 + i, base) for i in range(70)] + [(400, [2 * x for x in base]), (150, base)]  # copies; equal scores
    rows += [(500, None), (550, []), (600, [0.0] * 8), (650, [float("nan")] * 8), (700, [float("inf")] + [1.0] * 7),
             (750, [None] + [1.0] * 7), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (850, [1.0]), (None, base), (900, base), (900, base), (-50, [-x for x in base])]
    df = shipped.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert [j for _, j, _ in want[150]] == [200, 201, 202, 203, 204]
    assert 850 not in want and [j for _, j, _ in want[800]] == [801]
    same(rows_of(nb.nearest_neighbours(df)), want)
    same(rows_of(nb.nearest_neighbours(df.selectExpr("*", "1 as key", "2 as list", "'x' as q", "3 as rank", "4 as dim"))), want)


def test_one_id_on_several_vectors(shipped):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    got = nb.nearest_neighbours(shipped.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 1, 2), (0, 2, 1), (0, 2, 2)]


def test_empty(shipped):
    assert nb.nearest_neighbours(shipped.createDataFrame([], SCHEMA)).collect() == []
    assert nb.nearest_neighbours(shipped.createDataFrame([(50, [1.0, 2.0])], SCHEMA)).collect() == []


def test_recall_of_the_query(shipped):
    table = shipped.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, unit = table.vec_id.to_numpy(), nb.units(np.stack(table.embedding.to_numpy()).astype(np.float64))
    got = rows_of(queries.op11_neighbours(shipped, "/root/testdata/sf0.1"))
    hits, wanted = 0, 0
    for at in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[at]
        best = [x for x in np.lexsort((ids, -score)) if x != at][:5]
        own = {j: s for _, j, s in got[ids[at]]}
        hits, wanted = hits + len(own.keys() & set(ids[best].tolist())), wanted + 5
        assert all(abs(s - score[np.flatnonzero(ids == j)[0]]) < 1e-12 for j, s in own.items())
    assert hits >= 0.95 * wanted
