import numpy as np
import pytest

from corpusprep.llm import embeddings

NAN, INF = float("nan"), float("inf")


def brute(rows, cosine=0.98):
    """(vec_id, vec, label) rows -> sorted (vec_id, n_links, component, kept)."""
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    good = [usable(r) for r in rows]
    unit = [np.array(r[1], np.float32).astype(float) if g else None for r, g in zip(rows, good, strict=True)]
    unit = [u / np.abs(u).max() if u is not None else None for u in unit]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
            elif good[i] and good[j] and rows[i][0] == rows[j][0]:
                pass
    low = {}
    for i, r in enumerate(rows):
        if good[i]:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = low[find(i)] if good[i] else r[0]
        out.append((r[0], links[i], c, r[0] is not None and r[0] == c))
    return sorted(out, key=str)


def cloud(rng, dim, centres, each, spread):
    out = []
    for _ in range(centres):
        c = rng.normal(size=dim)
        for _ in range(each):
            v = c + rng.normal(size=dim) * spread * np.linalg.norm(c) / np.sqrt(dim)
            out.append(v.astype(np.float32).tolist())
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    vecs = cloud(rng, 16, 12, 18, 0.14) + cloud(rng, 16, 60, 1, 0) + cloud(rng, 8, 6, 8, 0.15)
    rows = [(int(i), v, int(rng.integers(0, 3))) for i, v in zip(rng.permutation(len(vecs)) + 10, vecs, strict=True)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(40)]  # copies
    rows += [(2000 + i, rows[0][1], rows[0][2]) for i in range(30)]  # many copies of one
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [1.0] * 15 + [NAN], 1), (3003, [1.0] * 15 + [None], 1), (3004, [INF] + [1.0] * 15, 1),
             (3005, [], 1), (3006, rows[0][1], None), (None, rows[0][1], rows[0][2]), (None, None, None), (3007, [1e-30] * 16, 1), (3008, [1e30] * 16, 1),
             (3009, [2.0], 1), (3010, [7.0], 1), (3011, [-7.0], 1)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("bucket_rows, tile", [(256, 2048), (2, 2048), (2, 5), (10_000, 7)])
def test_against_all_pairs(shipped, vectors, bucket_rows, tile):
    df = shipped.createDataFrame(vectors, SCHEMA).repartition(6)
    got = embeddings.near_duplicate_vectors(df, bucket_rows=bucket_rows, tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(vectors)


def test_every_close_pair_meets_in_a_bucket():
    rng = np.random.default_rng(1)
    for dim, bits in ((64, 14), (24, 20), (3, 3)):
        a = rng.normal(size=(300, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = a + rng.normal(size=a.shape) * 0.19 / np.sqrt(dim)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        close = (a * b).sum(axis=1) >= 0.98
        assert close.sum() > 50
        ya, yb = embeddings.rotated(a), embeddings.rotated(b)
        ha, hb = embeddings._home(ya, bits), embeddings._home(yb, bits)
        meets = np.zeros(len(a), bool)
        for y, home, other in ((ya, ha, hb), (yb, hb, ha)):
            row, mask = embeddings.visits(y, bits, 0.98)
            np.logical_or.at(meets, row, (home[row] ^ mask) == other[row])
        assert meets[close].all()


def test_the_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=64)
    q = rng.normal(size=(4000, 64))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    errors = []
    for seed in range(30):
        r, t = np.linalg.qr(np.random.default_rng(seed).normal(size=(64, 64)))
        y = (x / np.linalg.norm(x)) @ (r * np.sign(np.diag(t))).T
        z = q @ (r * np.sign(np.diag(t))).T
        code = np.where(y >= 0, 1, -1) / 8
        f = y @ code
        truth = z @ y
        error = z @ code / f - truth
        assert (np.abs(error) <= np.sqrt(1 - f * f) / f * np.sqrt(1 - truth ** 2) + 1e-9).all()
        errors.append(error.mean())
    assert abs(np.mean(errors)) < 0.005


def test_rotation_keeps_lengths():
    r = embeddings.rotation(32)
    assert np.allclose(r @ r.T, np.eye(32))


def test_empty_and_clashing_columns(shipped):
    assert embeddings.near_duplicate_vectors(shipped.createDataFrame([], SCHEMA)).count() == 0
    df = shipped.createDataFrame([(1, [1.0, 0.0], "a", 3, "z"), (2, [1.0, 0.01], "a", 4, None), (3, [1.0, 0.0], None, 5, "k")],
                                 "vec_id long, embedding array<double>, label string, n int, key string")
    got = sorted(tuple(r) for r in embeddings.near_duplicate_vectors(df).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
