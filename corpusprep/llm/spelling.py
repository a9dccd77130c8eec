"""Spelling variants: words at one edit, by a relational trie frontier.

Words are counted in tasks (per document, then per block of documents) and
added up by a grouped sum. The dictionary becomes two tries kept as one
distributed edge table: words read forwards (``dir`` 0) and backwards (``dir`` 1). A node
is named by its letters, and has a row only if two or more words
lie below it; the row holds its edges, at most one a letter. An edge to a single word carries
what that word has left, so nothing below it is stored; any other edge carries two 64-bit
signatures of the rests of the words below.

States ``(word, position, node, edits)`` are joined with the edges of one depth at
a time. A state without an edit stays on its word's own path; at each node it may
drop a letter or replace it by a later one, and goes on as a state with one edit,
which may only match. Inserted letters and earlier ones are the same
pairs seen from the other word, so pairs are turned round at the end. A step is taken only if the rest of the word is in the edge's
signatures: a wrong state may pass, a right one always does. A state that
reaches the end of both words, or an edge whose single word is what is
left to spell, is a pair of neighbours.

An edit leaves the first or the second half of a word whole. Forwards, states
start at the middle and edit the second half; backwards, they edit the first
half. So states never fan out at the crowded top of a trie.

Words of ``LONG`` or more letters would make the trie deep: pairs with a longer word meet
where deleting one letter from each (or from the longer) gives the
same string, by a rolling hash, and are then compared letter by letter.

Edge cases: null and empty texts have no words; in a row without an id no
letter is deleted; equal rows count each; a word without neighbours has no
form and is its own root; ties of ``n`` go to the smaller word; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import materialize

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
DELETE_EVERY = 31
#: From this length on, words are compared by deletions instead of by trie.
LONG = 48
#: Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 200_000


# ---------------------------------------------------------------- words

def _count(least_letters: int, delete_every: int):
    # a run that is too short cannot hold a match, a longer one is matched whole
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_letters)

    def run(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
            held.clear()
            return out
        for b in batches:
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                start = None if name is None else zlib.crc32(b"%d:" % name)
                for found, n in Counter(runs.findall(text.as_py() or "")).items():
                    raw = found.encode().lower()  # of bytes: A-Z only
                    word = raw.decode()
                    if start is not None:
                        h = zlib.crc32(raw, start)
                        if h % delete_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield flush()
        if held:
            yield flush()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
                least_count: int = LEAST_COUNT, delete_every: int = DELETE_EVERY) -> DataFrame:
    """``(word, n)``: the words of at least ``least_letters`` letters and ``least_count`` occurrences."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # tasks have combined already; a word has one row a hand-over, so none is hot
    found = src.mapInArrow(_count(least_letters, delete_every), "word string, c long").repartition("word")
    return found.groupBy("word").agg(F.sum("c").alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- trie

def _bits(rest: Column) -> list[Column]:
    """The two signatures of a rest of a word: one of 64 bits each."""
    h = F.xxhash64(rest)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int")) for x in (h, F.shiftright(h, 20))]


def _read(words: DataFrame) -> DataFrame:
    """Every word read in both directions: ``(dir, w, m)``."""
    return words.select(F.explode(F.array(F.struct(F.lit(0).alias("dir"), F.col("word").alias("w")),
                                          F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("w")))).alias("r")) \
        .select("r.dir", "r.w", F.length("r.w").alias("m"))


def _middle(m: Column) -> Column:
    """Where states start: half of the word, the larger half backwards."""
    return F.floor((m + F.col("dir")) / 2).cast("int")


def edge_table(words: DataFrame) -> DataFrame:
    """``(depth, dir, node, term, kids)``: the nodes with two or more words below, and
    their edges ``(c, rest, term, sig, sig2)``; ``rest`` is what a single word has left."""
    at = _read(words).withColumn("depth", F.explode(F.sequence(_middle(F.col("m")), F.col("m"))))
    rest = F.expr("substring(w, depth + 2)")
    bit, bit2 = _bits(rest)
    # a row without a letter is the end of a word at the node
    edge = at.select("dir", "depth", F.expr("substring(w, 1, depth)").alias("node"), F.expr("substring(w, depth + 1, 1)").alias("c"), rest.alias("rest"),
                     bit.alias("bit"), bit2.alias("bit2"))
    edges = edge.groupBy("depth", "dir", "node", "c").agg(F.count(F.lit(1)).alias("n"), F.min("rest").alias("rest"),
                                                         F.bit_or("bit").alias("sig"), F.bit_or("bit2").alias("sig2"))
    kid = F.when(F.col("c") != "", F.struct("c", F.when(F.col("n") == 1, F.col("rest")).alias("rest"), (F.col("rest") == "").alias("term"), "sig", "sig2"))
    nodes = edges.groupBy("depth", "dir", "node").agg(F.sum("n").alias("below"), F.max(F.col("c") == "").alias("term"), F.collect_list(kid).alias("kids"))
    return nodes.where("below > 1").drop("below")


def _steps(state: DataFrame) -> DataFrame:
    """All steps of states that stand at a node: ``(w, m, dir, i, node, edits, done)``."""
    def to_spell(at: str) -> Column:
        rest = F.expr(f"substring(w, {at} + 1)")
        bit, bit2 = _bits(rest)
        return F.struct(rest.alias("rest"), (rest == "").alias("none"), bit.alias("bit"), bit2.alias("bit2"))

    def over(kid: Column, left: Column) -> Column:
        """Whether ``left`` may be spelled below the edge; of an edge to one word, whether it is."""
        return F.when(kid["rest"].isNotNull(), kid["rest"] == left["rest"]).when(left["none"], kid["term"]) \
            .otherwise((kid["sig"].bitwiseAND(left["bit"]) != 0) & (kid["sig2"].bitwiseAND(left["bit2"]) != 0))

    def move(i: Column, edits: int, done: Column, *node: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), F.concat(F.col("node"), *node).alias("node"), F.lit(edits).alias("edits"), done.alias("done"))

    def steps(kids: Column, i: Column, left: Column) -> Column:
        """With an edit made: neighbours where one word or none is left to spell, states further down elsewhere."""
        end = lambda k: k["rest"].isNotNull() | left["none"]
        return F.transform(F.filter(kids, lambda k: over(k, left)),
                           lambda k: move(i, 1, end(k), k["c"], F.when(end(k), left["rest"]).otherwise(F.lit(""))))

    i, m, kids, fresh = F.col("i"), F.col("m"), F.col("kids"), F.col("edits") == 0
    no = F.filter(F.array(move(i, 1, F.lit(True))), lambda x: F.lit(False))

    def all_steps(at: Column) -> Column:  # ``at`` is worked out once a row, not once an edge
        own = F.filter(kids, lambda k: k["c"] == at["a"])
        match = F.transform(F.filter(own, lambda k: k["rest"].isNull()), lambda k: move(i + 1, 0, F.lit(False), k["c"]))
        replaced = F.when(i < m, steps(F.filter(kids, lambda k: k["c"] > at["a"]), i + 1, at["after"])).otherwise(no)
        dropped = F.when(i + 1 < m, steps(F.filter(kids, lambda k: k["c"] == at["b"]), i + 2, at["later"])) \
            .when((i + 1 == m) & F.col("term"), F.array(move(m, 1, F.lit(True)))).otherwise(no)
        return F.when(fresh, F.concat(match, replaced, dropped)).otherwise(steps(own, i + 1, at["after"]))

    at = F.struct(F.expr("substring(w, i + 1, 1)").alias("a"), F.expr("substring(w, i + 2, 1)").alias("b"),
                  to_spell("i + 1").alias("after"), to_spell("i + 2").alias("later"))
    moves = F.flatten(F.transform(F.array(at), all_steps))
    return state.select("w", "m", "dir", F.explode(moves).alias("_s")).select("w", "m", "dir", "_s.i", "_s.node", "_s.edits", "_s.done")


def _trie_pairs(words: DataFrame) -> DataFrame:
    """``(word, near)`` for all pairs of ``words`` at one edit, each from one side."""
    spark = words.sparkSession
    path = materialize(edge_table(words), "trie-edges")
    depths = [r[0] for r in path.select("depth").distinct().orderBy("depth").collect()]  # at most LONG
    starts = _read(words).select("w", "m", "dir", _middle(F.col("m")).alias("i")).withColumn("node", F.expr("substring(w, 1, i)")) \
        .withColumn("edits", F.lit(0))
    found, frontier = [], None
    for depth in range(depths[0] if depths else 0, depths[-1] + 1 if depths else 0):
        states = starts.where(F.col("i") == depth)
        if frontier is not None:
            states = states.unionByName(frontier.where("not done").drop("done"))
        edges = path.where(F.col("depth") == depth).drop("depth")
        # both sides are plain scans, so a crowded node is split at run time
        frontier = materialize(_steps(states.join(edges, ["dir", "node"])), f"trie-depth{depth}")
        found.append(frontier.where("done").select("dir", "w", "node"))
    if not found:
        return spark.createDataFrame([], "word string, near string")
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    turned = lambda c: F.when(F.col("dir") == 1, F.reverse(c)).otherwise(F.col(c))
    return every.select(turned("w").alias("word"), turned("node").alias("near"))


# ---------------------------------------------------------------- long words

_PRIMES = ((1 << 31) - 1, 2147483629)
_BASES = (1000003, 8191)


def _powers(base: int, p: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.int64)
    step = 1
    while step <= n:  # doubling
        out[step:2 * step] = out[:min(step, n + 1 - step)] * pow(base, step, p) % p
        step *= 2
    return out


def _terms(word: str):
    """Per prime: what each letter adds to the word's hash."""
    code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    for p, base in zip(_PRIMES, _BASES, strict=True):
        yield p, base, (code + 1) * _powers(base, p, len(code))[:-1] % p


def _whole_hash(word: str) -> int:
    out = 0
    for p, _, term in _terms(word):
        out = (out << 31) ^ int(term.sum() % p)
    return out


def _deletions(word: str) -> np.ndarray:
    """Hashes of the word and of the word without each of its letters, distinct."""
    total = np.zeros(len(word) + 1, np.int64)
    for p, base, term in _terms(word):
        ahead = np.concatenate([[0], np.cumsum(term) % p])  # sums stay below 2**63: under 2**31 a letter
        behind = (ahead[-1] - ahead[1:]) % p  # letters after i, one place too far
        less = (ahead[:-1] + behind * pow(base, -1, p)) % p
        total = (total << 31) ^ np.concatenate([[ahead[-1]], less])
    return np.unique(total)


def _long_pairs(words: DataFrame) -> DataFrame:
    """``(word, near)`` of words that share a deletion and are at one edit."""
    def run(batches):
        for b in batches:
            for w in b.column("word").to_pylist():
                h = _deletions(w)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([w] * len(h), pa.string())], names=["h", "word"])
    keys = materialize(words.select("word").mapInArrow(run, "h long, word string"), "long-deletions")
    pairs = keys.join(keys.withColumnRenamed("word", "near"), "h").where("word <> near").select("word", "near").distinct()
    return pairs.where(F.levenshtein("word", "near", 1) == 1)


# ---------------------------------------------------------------- forms

def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """``(word, near)``: every ordered pair of ``words(word)`` at exactly one
    inserted, deleted or replaced letter."""
    length = F.length("word")
    pairs = _trie_pairs(words.where(length <= long).select("word"))
    pairs = pairs.union(pairs.select("near", "word"))
    return pairs.union(_long_pairs(words.where(length >= long).select("word"))).distinct()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
                      least_count: int = LEAST_COUNT, factor: int = FACTOR, delete_every: int = DELETE_EVERY, long: int = LONG) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per word."""
    words = materialize(word_counts(docs, id_col, text_col, least_letters, least_count, delete_every), "words")
    pairs = near_words(words, long).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    more = F.coalesce(-F.col("best.n") >= factor * F.col("n"), F.lit(False))
    rows = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(more, F.col("best.near")).alias("form"),
        F.when(more, -F.col("best.n")).alias("form_n")), "word-forms")
    # counts grow by the factor at every step, so a path has at most 19 and halves each round
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = materialize(links.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "word-roots")
        if not links.where("_moved").limit(1).count():
            break
        links = links.drop("_moved")
    return rows.join(links.select("word", "root"), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS raw FROM documents
), runs AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM occurrences GROUP BY ALL HAVING length(run) >= 7
), hashed AS (
  SELECT run, c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
        lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + ord(x) // 64, 128 + ord(x) % 64] END)), lambda x: CAST(x AS BIGINT))),
    lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])) AS rest
  FROM runs, crc_table
), cut AS (
  SELECT run, c, xor(rest, 4294967295) AS h FROM hashed
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM cut GROUP BY 1 HAVING length(word) >= 7 AND n >= 2
), short AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), without AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS d FROM short
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.d = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS near_n, arg_min(near, (-near_n, near)) AS near FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), paths(word, here) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.here WHERE f.form IS NOT NULL
), roots AS (
  SELECT p.word, p.here AS root FROM paths p JOIN forms f ON f.word = p.here WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
"""
