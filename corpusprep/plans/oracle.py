"""SQL twins of the fixture views, for the DuckDB oracle.

The view texts are those of FIXTURES.md. An oracle query names the views it
reads; :func:`with_views` inlines them (and the views they build on) as
``WITH`` clauses, since the driver registers only the base tables. ``@key(x)``
is rewritten per engine.
"""

from __future__ import annotations

# Unpadded-hex MD5 key, per engine.
_KEY_PATTERN = "'0([0-9a-f])|([1-9a-f][0-9a-f])'"
KEY_DUCKDB = "regexp_replace(md5({x}), " + _KEY_PATTERN + ", '\\1\\2', 'g')"
KEY_SPARK = "regexp_replace(md5({x}), " + _KEY_PATTERN + ", '$1$2')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_samples": ((), """
SELECT page_id, url AS downloadurl,
  CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN NULL
    ELSE CAST(page_id - 90 AS STRING) END AS longitude,
  CASE WHEN page_id % 4 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(page_id AS DOUBLE) / 4 END AS latitude,
  CASE WHEN page_id % 6 = 0 THEN NULL ELSE page_id % 17 END AS accuracy,
  CASE WHEN page_id % 10 = 0 THEN 1 ELSE 0 END AS marker,
  CASE WHEN page_id % 3 = 0 THEN 'png' WHEN page_id % 10 = 0 THEN 'mp4'
    ELSE 'jpg' END AS ext,
  html AS payload
FROM pages"""),
    "samples": (("raw_samples",), """
SELECT *, substr(key, 1, 3) AS shard
FROM (SELECT *, @key(downloadurl) AS key FROM raw_samples) k"""),
    "candidates": (("samples",), """
SELECT page_id, key, shard, marker, payload, ord, canonical,
  CASE WHEN ord = 0 THEN canonical ELSE concat(stem, ext) END AS object_key
FROM (
  SELECT s.*, o.ord, concat(stem, CASE WHEN marker = 0 THEN 'jpg' ELSE 'mp4' END) AS canonical
  FROM (SELECT *, concat(CASE WHEN marker = 0 THEN 'data/images/' ELSE 'data/videos/mp4/' END,
          substr(key, 1, 3), '/', substr(key, 4, 3), '/', key, '.') AS stem FROM samples) s
  CROSS JOIN (SELECT 0 AS ord UNION ALL SELECT 1 AS ord) o) c"""),
    "store": (("candidates",), """
SELECT DISTINCT object_key, payload AS data FROM candidates
WHERE (page_id % 4 = 0 AND ord = 0) OR page_id % 4 = 2 OR (page_id % 4 = 3 AND ord = 1)"""),
    "archive": (("candidates",), """
SELECT shard, CAST(page_id % 997 AS INTEGER) AS ord, object_key AS name, payload AS data FROM candidates
WHERE ord = 0 AND page_id % 4 IN (0, 2) AND page_id % 7 <> 0
UNION ALL
SELECT shard, CAST(page_id % 997 + 1000 AS INTEGER) AS ord, object_key AS name, 'dup' AS data FROM candidates
WHERE ord = 0 AND page_id % 4 IN (0, 2) AND page_id % 7 <> 0 AND page_id % 6 = 0
UNION ALL
SELECT shard, CAST(page_id % 997 AS INTEGER) AS ord, regexp_replace(object_key, '[^.]+$', 'zzz') AS name, 'tie' AS data
FROM candidates WHERE ord = 0 AND page_id % 4 IN (0, 2) AND page_id % 7 <> 0 AND page_id % 10 = 2"""),
    "err_log": (("candidates",), """
SELECT shard, concat(canonical, ' ') AS line FROM candidates
WHERE ord = 0 AND (page_id % 4 IN (1, 3) OR page_id % 8 = 0)
UNION ALL
SELECT shard, canonical AS line FROM candidates WHERE ord = 0 AND page_id % 12 = 1"""),
    "ledger": (("samples",), """
SELECT shard FROM samples WHERE shard < '8'
UNION ALL
SELECT shard FROM samples WHERE shard < '2'"""),
    "vectors": ((), """
SELECT vec_id, @key(vk) AS key, vec_id % 3 = 0 AS already_done,
  CASE WHEN vec_id % 11 = 0 THEN NULL ELSE embedding END AS embedding
FROM (SELECT *, concat('vec/', CAST(vec_id AS STRING)) AS vk FROM embeddings) e"""),
    "images": ((), """
SELECT doc_id, 1 + n_chars % 1200 AS w, 1 + (n_chars * 7) % 900 AS h,
  n_chars AS n_bytes, CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END AS marker
FROM documents"""),
    "bench_keys": ((), """
SELECT @key(rk) AS key FROM (
  SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
    CAST(l_partkey AS STRING)) AS rk FROM lineitem) b"""),
    # DuckDB-only shape: one row per vector position.
    "pixels": ((), """
SELECT vec_id, CAST(i % 8 AS BIGINT) AS x, CAST((i - i % 8) / 8 AS BIGINT) AS y, CAST(v AS DOUBLE) AS v
FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i
      FROM embeddings) p"""),
    # --- oracle helper views (not fixtures: the SQL twins of operators) ---
    "coerced": (("samples",), """
SELECT page_id, downloadurl,
  CASE WHEN longitude IS NULL OR longitude = '' THEN NULL ELSE CAST(longitude AS DOUBLE) END AS longitude,
  CASE WHEN latitude IS NULL OR latitude = 0 THEN NULL ELSE latitude END AS latitude,
  CASE WHEN accuracy IS NULL OR accuracy = 0 THEN NULL ELSE accuracy END AS accuracy,
  marker, ext, payload, key, shard
FROM samples"""),
    "hits": (("candidates", "store"), """
SELECT c.page_id, c.ord, c.object_key, s.data
FROM candidates c JOIN store s ON s.object_key = c.object_key"""),
    "resolved": (("candidates", "hits"), """
SELECT c.page_id, c.key, c.shard, c.marker, COALESCE(h.object_key, c.canonical) AS object_key, h.data,
  h.page_id IS NOT NULL AS found
FROM candidates c
LEFT JOIN (SELECT page_id, min(ord) AS ord FROM hits GROUP BY page_id) b ON b.page_id = c.page_id
LEFT JOIN hits h ON h.page_id = b.page_id AND h.ord = b.ord
WHERE c.ord = 0"""),
    "missing": (("samples", "candidates", "archive", "store"), """
SELECT s.page_id, s.key, s.shard FROM samples s
WHERE NOT EXISTS (SELECT 1 FROM candidates c JOIN archive a ON a.name = c.object_key AND a.shard = c.shard
                  WHERE c.page_id = s.page_id)
  AND EXISTS (SELECT 1 FROM candidates c JOIN store t ON t.object_key = c.object_key
              WHERE c.page_id = s.page_id)"""),
    "errkeys": (("err_log", "archive"), """
SELECT DISTINCT e.shard, trim(e.line) AS object_key FROM err_log e
WHERE trim(e.line) <> ''
  AND NOT EXISTS (SELECT 1 FROM archive a WHERE a.shard = e.shard AND a.name = trim(e.line))"""),
    "repaired": (("candidates", "store", "errkeys"), """
SELECT c.page_id, c.key, c.shard, COALESCE(h.object_key, c.canonical) AS object_key, h.data,
  h.page_id IS NOT NULL AS found
FROM candidates c
JOIN (SELECT DISTINCT page_id FROM candidates
      WHERE object_key IN (SELECT object_key FROM errkeys)) t ON t.page_id = c.page_id
LEFT JOIN (SELECT rc.page_id, min(rc.ord) AS ord FROM candidates rc JOIN store s ON s.object_key = rc.object_key
           WHERE rc.object_key IN (SELECT object_key FROM errkeys) GROUP BY rc.page_id) b
  ON b.page_id = c.page_id
LEFT JOIN (SELECT rc.page_id, rc.ord, rc.object_key, s.data FROM candidates rc
           JOIN store s ON s.object_key = rc.object_key) h ON h.page_id = b.page_id AND h.ord = b.ord
WHERE c.ord = 0"""),
    "members": (("archive",), """
SELECT shard, ord, name, data,
  CASE WHEN regexp_matches(base, '^.+[.][^.]+$') THEN regexp_extract(base, '^(.+)[.][^.]+$', 1)
       ELSE base END AS key
FROM (SELECT *, regexp_extract(regexp_replace(name, '/+$', ''), '([^/]*)$', 1) AS base FROM archive) a"""),
    "first_members": (("members",), """
SELECT shard, key, min(struct_pack(o := ord, n := name)) AS f FROM members GROUP BY shard, key"""),
    "features": (("vectors",), """
SELECT p.vec_id, v.key,
  CAST(sum(((p.i * 7 + 0 * 13) % 5 - 2) * floor(p.v * 1000)) AS BIGINT) AS y0,
  CAST(sum(((p.i * 7 + 1 * 13) % 5 - 2) * floor(p.v * 1000)) AS BIGINT) AS y1,
  CAST(sum(((p.i * 7 + 2 * 13) % 5 - 2) * floor(p.v * 1000)) AS BIGINT) AS y2,
  CAST(sum(((p.i * 7 + 3 * 13) % 5 - 2) * floor(p.v * 1000)) AS BIGINT) AS y3
FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS i
      FROM embeddings) p
JOIN vectors v ON v.vec_id = p.vec_id
WHERE v.embedding IS NOT NULL
GROUP BY p.vec_id, v.key"""),
}


def _expand(names, seen: list[str]) -> None:
    for n in names:
        deps, _ = VIEWS[n]
        _expand(deps, seen)
        if n not in seen:
            seen.append(n)


def with_views(views, body: str, engine: str = "duckdb") -> str:
    """Inline the named views (and their dependencies) as WITH clauses."""
    order: list[str] = []
    _expand(views, order)
    ctes = [f"{n} AS ({VIEWS[n][1].strip()})" for n in order]
    extra = ""
    body = body.strip()
    if body.upper().startswith("WITH "):
        # the body has its own CTEs: append them after the views
        extra = body[5:]
        sql = "WITH " + ",\n".join(ctes + [extra]) if ctes else body
    else:
        sql = ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
    return translate(sql, engine)


def translate(sql: str, engine: str = "duckdb") -> str:
    """Rewrite every ``@key(expr)`` (balanced parentheses) for ``engine``."""
    tpl = KEY_DUCKDB if engine == "duckdb" else KEY_SPARK
    out, i = [], 0
    while True:
        j = sql.find("@key(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 0, j + 4
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(tpl.format(x=translate(sql[j + 5:k], engine)))
        i = k + 1
