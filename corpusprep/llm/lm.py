"""Language-model scoring by a weighted backoff automaton.

The model is an interpolated n-gram model over lower-cased words and an end
token, learned from the training documents (``crc32(id as text) mod 7 <> 2``):

    P1(w)     = (c(w) + 1) / (N + V + 1)
    Pn(w | h) = (1 - L_n) c(h w) / c(h) + L_n P(n-1)(w | h without its first word)

``L_n`` is the Good-Turing share of unseen n-grams: those seen once over all.
It sums to one over the vocabulary and one unknown word. As an automaton: a
context with ``c(h) > 0`` is a state; an n-gram seen in training is an arc with
weight ``log10 Pn``; any other word takes the state's failure arc, weight
``log10 L_n``, to the state of the shorter context, down to the unigrams. A
traversal would go over a text once from left to right, the state being the
last words read. ``_score`` builds no states or arcs and carries no state: the
state at a position is fixed by the words before it, so the weights of all
positions of a block are evaluated in one array pass per order, as lookups of
n-gram counts by hash. The probabilities are the automaton's; a traversal
would step through every word in Python.

The automaton of the whole corpus is never in one place. Documents are dealt
into blocks by ranges of their id. One pass gathers the distinct n-grams of
each block with their training counts, as sorted arrays of 64-bit hashes cut
into shards; each shard adds up the counts of all blocks, and sends every block
the totals of its own n-grams. A block thus gets the part of the automaton its
texts can reach, and its documents are scored against that part. What is
gathered grows with the corpus; what a task holds is bounded by
``block_bytes``.

Edge cases: a null or empty text is the end token alone; a null id trains (its
remainder is not 2) and is dealt by its text; repeated rows are counted and
scored each; without training documents every token is unknown (probability 1);
an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import materialize, range_bounds, range_of

ORDER = 2
FOLDS = 7
HELD_OUT = 2
BLOCK_BYTES = 8 << 20
#: Tokens a task gathers before it hands on the counts of its earlier blocks.
FLUSH_TOKENS = 1_000_000
START, END = b"\n<s>", b"\n</s>"  # words hold no white space


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


class _Words(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class _Grams:
    """Documents as one run of n-gram hashes: every document is START, its words, END."""

    def __init__(self):
        self.words = _Words()
        self.start, self.end = self.words[START], self.words[END]
        self.parts, self.sizes, self.flags = [], [], []

    def add(self, text: bytes | None, flag: bool) -> None:
        words = text.lower().split() if text else []
        ids = np.empty(len(words) + 2, np.int32)
        ids[0], ids[-1] = self.start, self.end
        ids[1:-1] = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        self.parts.append(ids)
        self.sizes.append(len(ids))
        self.flags.append(flag)

    def levels(self, order: int):
        """``(hashes, where)`` per n: of the n-grams ending at positions ``where``."""
        seq = np.concatenate(self.parts)
        self.parts.clear()
        digest = xxhash.xxh64_intdigest
        hashed = np.fromiter(map(digest, self.words), np.uint64, len(self.words))
        self.words.clear()
        hashed = hashed[seq]
        open_ = seq == self.start
        where = np.flatnonzero(~open_)
        key = hashed
        yield hashed[where], where
        for _ in range(2, order + 1):
            # the gram one shorter that ends just before, and this word; none reaches past START
            where = where[where > 0]
            longer = np.zeros(len(seq), np.uint64)
            longer[where] = _mix(key[where - 1] * np.uint64(0x9E3779B97F4A7C15) + hashed[where])
            key = longer
            yield key[where], where
            where = where[~open_[where - 1]]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys pass from one shard (an equal part of the hash range) to the next."""
    bounds = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def _pack(counts: np.ndarray) -> bytes:
    """Counts in the narrowest integers that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {0: "u1", 1: "u1", 2: "u2", 4: "u4", 8: "u8"}[len(data) // n if n else 0]).astype(np.int64)


_KEYS = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _gather(order: int, shards: int):
    """Of documents ``(block, train, text)``: sorted distinct n-grams and training counts per block and shard."""
    def flush(blocks, names):
        rows = []
        for block in names:
            grams = blocks.pop(block)
            train = np.repeat(np.array(grams.flags, bool), grams.sizes)
            for level, (keys, where) in enumerate(grams.levels(order), 1):
                distinct, place = np.unique(keys, return_inverse=True)
                counts = np.bincount(place[train[where]], minlength=len(distinct))
                cuts = _cuts(distinct, shards)
                rows += [(level, s, block, distinct[a:z].tobytes(), _pack(counts[a:z]))
                         for s, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a]
        if rows:
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _KEYS, strict=True)], schema=_KEYS)

    def run(batches):
        blocks, held = {}, 0
        for b in batches:
            for block, train, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), strict=True):
                if held > FLUSH_TOKENS:  # the block being read goes on, unless it alone is too much
                    done = [k for k in blocks if k != block] or [block]
                    held -= sum(sum(blocks[k].sizes) for k in done if k in blocks)
                    yield from flush(blocks, [k for k in done if k in blocks])
                grams = blocks.get(block)
                if grams is None:
                    grams = blocks[block] = _Grams()
                grams.add(text.as_py(), train)
                held += grams.sizes[-1]
        yield from flush(blocks, list(blocks))
    return run


_TOTALS = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()), ("n", pa.int64()),
                     ("tokens", pa.int64()), ("types", pa.int64()), ("once", pa.int64())])


def _add_up(table: pa.Table) -> pa.Table:
    """One shard of one level: the totals of each block's n-grams, in the order
    of their hashes, and (in the first row) the shard's sums."""
    level, shard = table.column("level")[0].as_py(), table.column("shard")[0].as_py()
    blocks = table.column("block").to_numpy()
    keys = [np.frombuffer(k.as_py(), np.uint64) for k in table.column("keys")]
    counts = [_unpack(c.as_py(), len(k)) for c, k in zip(table.column("counts"), keys, strict=True)]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    starts = np.cumsum([0, *map(len, keys)])
    for i, c in enumerate(counts):
        total[place[starts[i]:starts[i + 1]]] += c  # a row's keys are distinct
    sums = (int(total.sum()), int((total > 0).sum()), int((total == 1).sum()))
    rows = []
    for block in np.unique(blocks):
        own = [place[starts[i]:starts[i + 1]] for i in np.flatnonzero(blocks == block)]
        at = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
        rows.append((level, shard, int(block), _pack(total[at]), len(at), *(sums if not rows else (0, 0, 0))))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TOTALS, strict=True)], schema=_TOTALS)


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(order: int, tokens: int, types: int, train_docs: int, lambdas: list[float]):
    """Block documents ``(block, train, doc_id, text)`` against the block's totals."""
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        grams = _Grams()
        train = docs.column("train").to_pylist()
        for text, t in zip(docs.column("text").cast(pa.binary()), train, strict=True):
            grams.add(text.as_py(), t)
        by = {}
        for level, shard, n, data in zip(*(totals.column(c).to_pylist() for c in ("level", "shard", "n", "totals")), strict=True):
            by.setdefault(level, []).append((shard, _unpack(data, n)))
        context = None  # training count of the state each position is read in
        prob = None
        for level, (keys, where) in enumerate(grams.levels(order), 1):
            distinct, place = np.unique(keys, return_inverse=True)
            total = np.concatenate([t for _, t in sorted(by[level], key=lambda x: x[0])])
            seen = total[place].astype(np.float64)
            if level == 1:
                size = sum(grams.sizes)
                count = np.zeros(size)
                count[where] = seen
                prob = np.ones(size)
                prob[where] = (seen + 1) / (tokens + types + 1)
                base = prob.copy()
                known = count > 0
                context = count.copy()
                starts = np.concatenate([[0], np.cumsum(grams.sizes)[:-1]])
                context[starts] = train_docs
                continue
            state = context[where - 1]
            ok = state > 0  # else the failure arcs lead on without a cost
            at = where[ok]
            lam = lambdas[level - 2]
            prob[at] = (1 - lam) * seen[ok] / state[ok] + lam * prob[at]
            context = np.zeros(len(prob))
            context[where] = seen
        add = lambda x: np.add.reduceat(x, starts)
        words = np.array(grams.sizes) - 1  # START is no token; its probability is 1
        out = [docs.column("doc_id").combine_chunks(), pa.array([not t for t in train]), pa.array(words, pa.int64()),
               pa.array(add(known.astype(np.int64)), pa.int64()), pa.array([tokens] * len(words), pa.int64()),
               pa.array(add(np.log10(base))), pa.array(add(np.log10(prob)))]
        return pa.table(out, names=names)
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row (log10 of the unigram and of the model's probability)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("train", ~held_out("doc_id"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-int(size[0]) // block_bytes))
    bounds = range_bounds(src, "doc_id", blocks)
    # ranges of the id: files written in id order then hold few blocks each, so counts combine early
    block = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(len(bounds) + 1))).otherwise(range_of(bounds, "doc_id")).cast("long")
    dealt = src.withColumn("block", block)

    keys = dealt.select("block", "train", "text").mapInArrow(_gather(order, blocks), "level int, shard int, block long, keys binary, counts binary")
    totals = materialize(keys.groupBy("level", "shard").applyInArrow(
        _add_up, "level int, shard int, block long, totals binary, n long, tokens long, types long, once long"), "lm-totals")
    sums = {r["level"]: r for r in totals.groupBy("level").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"),
                                                               F.sum("once").alias("once")).collect()}  # one row a level
    tokens, types = (int(sums[1]["tokens"]), int(sums[1]["types"])) if sums else (0, 0)
    lambdas = [min(0.95, max(0.05, int(sums[n]["once"]) / max(1, int(sums[n]["tokens"])))) if n in sums else 1.0 for n in range(2, order + 1)]
    return dealt.select("block", "train", "doc_id", "text").groupBy("block") \
        .cogroup(totals.select("block", "level", "shard", "n", "totals").groupBy("block")) \
        .applyInArrow(_score(order, tokens, types, int(size[1]), lambdas), _OUT)
