"""Phrase collocations from count streams kept in prefix and in suffix order.

1. Counting. Tasks cut blocks of at most ``BLOCK_BYTES`` of text into words,
   count their phrases by sorting, and a grouped sum adds the blocks up: first
   words, then pairs of which both words pass a filter, then phrases of three and four
   words of which all pairs pass one. A filter has ``2 ** filter_bits`` bits,
   whatever it holds, and holds every word (pair) with ``least`` or more
   occurrences. It has no false negatives, so the counts of frequent phrases
   are exact; a full one only lets more phrases through.
2. Streams. Phrases of all orders with ``least`` or more occurrences make one
   stream in prefix order (sorted by their words) and one in suffix order (by
   their words from the last). In prefix order a phrase stands before all
   that it begins, so one pass holding the open phrases, at most
   ``longest`` of them, reads off the count of every beginning (the left counts) and
   the largest count among a phrase's extensions by one word. The pass over the
   suffix order gives the counts of all ends and the extensions to the left.
   A phrase inside a longer one is inside one longer by a single word that
   is at least as frequent, so these extensions decide the containment rule.
   Streams are cut by range at any phrase, so no word's phrases meet in one
   task; what is open at a cut is carried on by one row per range.
3. The two passes meet in one grouped maximum, and each language's best are
   ranked in two steps, the first over ``SALTS`` parts of a language.

Scores use decimals of up to 38 digits and whole division.

Edge cases: a null text counts as empty, a null language as ``und``; rows
without words add nothing; equal rows count each; phrases never cross pieces
or rows; ties rank by count, then phrase; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import materialize

LEAST = 30
KEEP = 2000
LONGEST = 4
BLOCK_BYTES = 6 << 20
FILTER_BITS = 26
SALTS = 64
#: The second word of a single word's place in a filter: the hash of no text.
NO_WORD = np.uint64(xxhash.xxh64_intdigest(b""))

#: Byte classes: 0 in a word, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Block:
    """The words of some texts: ``words`` (sorted, distinct), and for every word
    in order its ``code`` and ``lang``; ``joined`` says that the next word is in the same piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, np.uint8)
        first = offsets[:-1] - offsets[0]
        kind = _CLASS[data]
        inside = kind == 0
        cut = np.zeros(len(data) + 1, bool)  # a text begins here
        cut[first] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        walls = np.sort(np.concatenate([np.flatnonzero(kind == 2), first]))
        piece = np.searchsorted(walls, start, side="right")
        at = np.concatenate([[0], np.cumsum(stop - start)])
        found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(_LOWER[data[inside]])])
        coded = found.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = coded.dictionary.take(pa.array(order))
        self.code = rank[coded.indices.to_numpy()] if len(start) else np.zeros(0, np.int64)
        tongue = langs.fill_null("und").dictionary_encode()
        self.langs = tongue.dictionary
        of_text = tongue.indices.to_numpy().astype(np.int64)
        self.lang = of_text[np.searchsorted(first, start, side="right") - 1] if len(start) else np.zeros(0, np.int64)
        self.joined = piece[1:] == piece[:-1]

    def extend(self, place: np.ndarray, ids: np.ndarray, back: int) -> tuple[np.ndarray, ...]:
        """Phrases at the words ``place``, named by ``ids``, made longer by the word ``back`` on:
        (distinct old id, distinct new word, count, new dense id per place)."""
        key = ids * len(self.words) + self.code[place + back]
        found, dense, count = np.unique(key, return_inverse=True, return_counts=True)
        return found // len(self.words), found % len(self.words), count, dense

    def singles(self) -> tuple[np.ndarray, ...]:
        key = self.lang * max(1, len(self.words)) + self.code
        found, dense, count = np.unique(key, return_inverse=True, return_counts=True)
        return found // max(1, len(self.words)), found % max(1, len(self.words)), count, dense

    def rows(self, lang: np.ndarray, codes: list[np.ndarray], count: np.ndarray) -> list[pa.RecordBatch]:
        """``(phrase, c)``: the words, a tab, the language. Words hold neither spaces nor
        tabs. One short string a row is what the shuffle carries best."""
        words = [self.words.take(pa.array(c)) for c in codes] or [pa.array([b""] * len(lang), pa.large_binary())]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if len(words) > 1 else words[0]
        phrase = pc.binary_join_element_wise(phrase, self.langs.cast(pa.large_binary()).take(pa.array(lang)), pa.scalar(b"\t", pa.large_binary()))
        phrase = phrase.cast(pa.large_string()).cast(pa.string())
        return pa.table([phrase, pa.array(count.astype(np.int64))], names=["phrase", "c"]).to_batches(max_chunksize=1 << 16)


def _blocks(batches):
    """Blocks of about ``BLOCK_BYTES`` of text (a longer text is one of its own)."""
    held, size = [], 0

    def block():
        t = pa.Table.from_batches(held).combine_chunks()
        return Block(_whole(t.column("text")), _whole(t.column("lang")))
    for b in batches:
        # positions where the running size passes a block's
        length = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (size + np.cumsum(length)) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(length)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            held.append(b.slice(a, z - a))
            if z < len(length):
                yield block()
                held = []
        size = int((size + length.sum()) % BLOCK_BYTES)
    if held:
        yield block()


def _whole(column) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _words(batches):
    """Counts of words, and of all words of a language (its row has no word)."""
    for block in _blocks(batches):
        lang, code, count, _ = block.singles()
        total = np.bincount(lang, weights=count, minlength=len(block.langs)).astype(np.int64)
        yield from block.rows(np.arange(len(block.langs)), [], total)
        yield from block.rows(lang, [code], count)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def _spots(lang: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of ``2 ** bits`` bits, from hashes of a language and of two words."""
    with np.errstate(over="ignore"):
        x = (lang * np.uint64(0x9E3779B97F4A7C15) ^ a) * np.uint64(0xBF58476D1CE4E5B9) + b
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
    mask = np.uint64((1 << bits) - 1)
    return x & mask, (x >> np.uint64(32)) & mask


def _passes(table: np.ndarray, lang: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(a), bool)
    for spot in _spots(lang, a, b, bits):
        ok &= (table[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def _filter_words(bits: int):
    def run(batches):
        for b in batches:
            lang, first, second = (_hashes(b.column(c)) for c in ("lang", "w1", "w2"))
            spots = np.concatenate(_spots(lang, first, second, bits))
            slot, inverse = np.unique(spots >> np.uint64(6), return_inverse=True)
            held = np.zeros(len(slot), np.uint64)
            np.bitwise_or.at(held, inverse, np.uint64(1) << (spots & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(held.view(np.int64))], names=["slot", "held"])
    return run


def phrase_filter(phrases: DataFrame, bits: int) -> np.ndarray:
    """A bit filter of all ``(lang, w1, w2)``: ``2 ** bits / 64`` numbers, whatever the rows."""
    found = phrases.select("lang", "w1", "w2").mapInArrow(_filter_words(bits), "slot long, held long") \
        .groupBy("slot").agg(F.bit_or("held").alias("held")).toArrow()  # at most 2 ** bits / 64 rows
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("held").to_numpy().view(np.uint64)
    return out


def _good_pairs(block: Block, words: np.ndarray, bits: int):
    """The pairs of words that both pass: places, dense ids, then language, words and count of the distinct ones."""
    lang, code, _, single = block.singles()
    h, tongue = _hashes(block.words), _hashes(block.langs)
    known = _passes(words, tongue[lang], h[code], np.full(len(code), NO_WORD), bits)[single] if len(code) else np.zeros(0, bool)
    place = np.flatnonzero(block.joined & known[:-1] & known[1:])
    old, new, count, dense = block.extend(place, single[place], 1)
    return place, dense, lang[old], [code[old], new], count, h, tongue


def _pairs(held, bits: int):
    """Counts of pairs whose words both pass the filter."""
    def run(batches):
        for block in _blocks(batches):
            if len(block.code):
                _, _, lang, codes, count, _, _ = _good_pairs(block, held.value, bits)
                yield from block.rows(lang, codes, count)
    return run


def _longer(held, pairs_held, bits: int, longest: int):
    """Counts of phrases of 3 to ``longest`` words whose pairs all pass the filter."""
    def run(batches):
        for block in _blocks(batches):
            if not len(block.code):
                continue
            place, dense, lang, codes, _, h, tongue = _good_pairs(block, held.value, bits)
            keep = _passes(pairs_held.value, tongue[lang], h[codes[0]], h[codes[1]], bits)[dense]
            place, ids = place[keep], dense[keep]
            good = np.zeros(len(block.code), bool)  # a good pair begins here
            good[place] = True
            for k in range(2, longest):
                more = good[place + k - 1]  # one begins at the phrase's last word
                place, ids = place[more], ids[more]
                if not len(place):
                    break
                old, new, count, ids = block.extend(place, ids, k)
                lang, codes = lang[old], [*(c[old] for c in codes), new]
                yield from block.rows(lang, codes, count)
    return run


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                     filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, f)`` of all phrases of up to ``longest`` words with ``least`` or
    more occurrences, single words included, and ``(lang, n)``, all words of a language."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    send = src.sparkSession.sparkContext.broadcast

    def counted(run, name: str) -> DataFrame:
        """Summed over blocks; a phrase has one row a block, so none is hot, and blocks are combined already."""
        total = src.mapInArrow(run, "phrase string, c long").repartition("phrase").groupBy("phrase").agg(F.sum("c").alias("f"))
        kept = materialize(total.where((F.col("f") >= least) | F.col("phrase").startswith("\t")), name)
        tab = F.instr("phrase", "\t")
        return kept.select(F.col("phrase").substr(tab + 1, F.length("phrase")).alias("lang"),
                           F.array_remove(F.split(F.col("phrase").substr(F.lit(1), tab - 1), " "), "").alias("words"), "f")

    words = counted(_words, "phrases-1")
    totals = words.where("size(words) = 0").select("lang", F.col("f").alias("n"))
    grams = words.where("size(words) = 1")
    if longest > 1:
        held = send(phrase_filter(grams.select("lang", F.col("words")[0].alias("w1"), F.lit("").alias("w2")), filter_bits))
        pairs = counted(_pairs(held, filter_bits), "phrases-2")
        grams = grams.union(pairs)
    if longest > 2:
        pairs_held = send(phrase_filter(pairs.select("lang", F.col("words")[0].alias("w1"), F.col("words")[1].alias("w2")), filter_bits))
        grams = grams.union(counted(_longer(held, pairs_held, filter_bits, longest), "phrases-long"))
    return grams, totals


# ---------------------------------------------------------------- streams

def _pass(longest: int):
    """One pass over a range of the stream. Rows of kind 0: a phrase with the counts
    ``b1..`` of its beginnings (null where they stand in an earlier range); kind 1: a
    phrase's largest extension in this range; kind 2: the counts open at the range's end."""
    depth = longest - 1

    def run(batches):
        part = TaskContext.get().partitionId()
        path: list[list] = []  # [word, count or None, largest extension] of the open phrases
        tongue, last, out = None, [None] * depth, []

        def close(to: int):
            while len(path) > to:
                if path[-1][2]:
                    out.append((1, part, tongue, [p[0] for p in path], None, path[-1][2], *[None] * depth))
                path.pop()

        def flush():
            cols = list(zip(*out, strict=True))
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64(), *[pa.int64()] * depth]
            names = ["kind", "part", "lang", "words", "f", "ext", *[f"b{i + 1}" for i in range(depth)]]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
            out.clear()
            return batch

        for b in batches:
            for lang, words, f in zip(*(b.column(c).to_pylist() for c in ("lang", "words", "f")), strict=True):
                if lang != tongue:
                    close(0)
                    tongue = lang
                same = 0
                while same < min(len(path), len(words) - 1) and path[same][0] == words[same]:
                    same += 1
                close(same)
                path.extend([w, None, 0] for w in words[same:-1])  # begun in an earlier range
                begun = [p[1] for p in path]
                out.append((0, part, lang, words, f, None, *begun, *[None] * (depth - len(begun))))
                if path:
                    path[-1][2] = max(path[-1][2], f)
                path.append([words[-1], f, 0])
                if len(words) <= depth:
                    last[len(words) - 1] = f
            if out:
                yield flush()
        close(0)
        out.append((2, part, None, None, None, None, *last))
        yield flush()
    return run


def stream_pass(grams: DataFrame, longest: int = LONGEST, ranges: int | None = None) -> DataFrame:
    """``(lang, words, f, ext, b1..)``: every phrase of ``grams`` with the counts of
    its beginnings, and rows with ``ext``, the largest count of an extension by one word."""
    spark = grams.sparkSession
    begun = [f"b{i + 1}" for i in range(longest - 1)]
    schema = "kind int, part int, lang string, words array<string>, f long, ext long, " + ", ".join(f"{b} long" for b in begun)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = grams.repartitionByRange(ranges, "lang", "words").sortWithinPartitions("lang", "words")
    done = materialize(stream.mapInArrow(_pass(longest), schema), "phrases-pass")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = done.where("kind = 2").select("part", *[F.last(b, ignorenulls=True).over(before).alias(f"_{b}") for b in begun])
    rows = done.where("kind < 2").join(F.broadcast(carry), "part", "left")  # one row a range
    known = [F.when((F.col("kind") == 0) & (F.size("words") > i + 1), F.coalesce(b, f"_{b}")).alias(b) for i, b in enumerate(begun)]
    return rows.select("lang", "words", "f", "ext", *known)


def _exact(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, keep: int = KEEP,
                      longest: int = LONGEST, filter_bits: int = FILTER_BITS, ranges: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``keep`` best phrases."""
    grams, totals = frequent_phrases(docs, text_col, lang_col, least, longest, filter_bits)
    begun = [f"b{i + 1}" for i in range(longest - 1)]
    ended = [f"e{i + 1}" for i in range(longest - 1)]
    none = [F.lit(None).cast("long").alias(c) for c in begun]
    front = stream_pass(grams, longest, ranges).select("lang", "words", "f", "ext", *begun, *[x.alias(e) for x, e in zip(none, ended, strict=True)])
    back = stream_pass(grams.withColumn("words", F.reverse("words")), longest, ranges) \
        .select("lang", F.reverse("words").alias("words"), F.lit(None).cast("long").alias("f"), "ext", *none,
                *[F.col(b).alias(e) for b, e in zip(begun, ended, strict=True)])
    met = front.union(back).groupBy("lang", "words").agg(*[F.max(c).alias(c) for c in ("f", "ext", *begun, *ended)])
    whole = met.where((F.size("words") > 1) & ~F.coalesce(_exact(F.col("ext")) * 5 >= _exact(F.col("f")) * 4, F.lit(False)))
    cuts = []
    for k in range(1, longest):
        left = F.col(f"b{k}")
        right = F.element_at(F.array(*ended), F.size("words") - k)
        score = F.call_function("div", _exact(F.col("f")) * F.lit(2000000).cast("decimal(7,0)"), _exact(left) + _exact(right))
        cuts.append(F.when(F.size("words") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))))
    best = whole.withColumn("cut", F.array_min(F.array_compact(F.array(*cuts)))) \
        .select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = best.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_at") <= keep)
    top = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= keep)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), counts AS (
  SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS f FROM places GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, words, f AS a FROM counts WHERE k >= 2 AND f >= 30
), cut AS (
  SELECT lang, k, words, a, unnest(range(1, k)) AS j FROM candidates
), scored AS (
  SELECT c.lang, c.words, c.a, c.j, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * c.a) // (l.f + r.f) AS BIGINT) AS score
  FROM cut c JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:c.j] JOIN counts r ON r.lang = c.lang AND r.words = c.words[c.j + 1:c.k]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1
), inner_places AS (
  SELECT lang, k, words, a, s, unnest(range(1, k - s + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS s) WHERE s < k
), inside AS (
  SELECT lang, words[i:i + s - 1] AS words, max(a) AS longer FROM inner_places GROUP BY ALL
), ranked AS (
  SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.score,
    row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, array_to_string(b.words, ' ')) AS rank
  FROM best b LEFT JOIN inside x ON x.lang = b.lang AND x.words = b.words
  WHERE x.longer IS NULL OR 100::HUGEINT * x.longer < 80::HUGEINT * b.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
