"""Brute-force versions shared by tests."""

import xxhash


def brute_fingerprint(text, shingle=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=3):
    """Rows (id, fingerprint) -> component per row; null ids name nothing."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    fps = sorted({f for _, f in rows})
    named = {}
    for i, f in rows:
        if i is not None:
            named.setdefault(f, []).append(i)
    for a in fps:
        for i in named.get(a, []):
            parent[find(("f", a))] = find(("i", i))
    for x, a in enumerate(fps):
        for b in fps[x + 1:]:
            if bin(a ^ b).count("1") <= radius and a in named and b in named:
                parent[find(("f", a))] = find(("f", b))
    low = {}
    for i, f in rows:
        if i is not None:
            r = find(("f", f))
            low[r] = min(low.get(r, i), i)
    return [low.get(find(("f", f))) for _, f in rows]
