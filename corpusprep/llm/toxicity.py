"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

``x_i`` says whether a text has term ``i``: a lower-cased run of letters, hashed
to ``HASH_BITS`` bits. The factor products let two terms weigh together what
neither weighs alone (an insult and the mention of a group).

Training uses a bounded sample of labelled rows: about ``SAMPLE_ROWS`` of them,
chosen by a hash of their id (all, where there are fewer). Every hashed term of
the sample is an input with a weight and a factor; none is screened out. With
far more terms than rows, penalties keep noise out, and each is set by what
labels dealt out at random would reach: weights pay an absolute penalty of
``EASE`` times the largest gradient under shuffled errors (and a tenth of that
once a term is in), factors a square penalty as large as the strongest
interaction that shuffled errors show. Inputs are scaled by
``sqrt(share of rows without the term / (rows with it + PRIOR_ROWS))``: a rare term
has to earn its weight, and a term of every row says nothing. Factors start along the strongest interactions of the errors that the
weights leave, so two words that say nothing alone are found by their pair.

The sample's rows reach the driver as arrays of term numbers (bounded by
``SAMPLE_ROWS``), where the fit runs from a fixed seed. Scoring is one narrow
pass over whole texts with the model as a broadcast: terms whose weight and
factor came out as zero are left out of it, and there are at most
``2 ** HASH_BITS`` others.

Edge cases: null and empty texts have no terms and score ``sigmoid(w0)``; null
ids are kept and never train; ids labelled more than once train once, as toxic
if any label says so; null labels are ignored; without labels of both kinds the
score is the share of toxic labels (0 without labels); an empty table gives no
rows; columns other than id and text (and the label table's id and label) are
not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 20
SAMPLE_ROWS = 20_000
FACTORS = 6
STEPS = 80
PRIOR_ROWS = 100
EASE = 0.5
SEED = 7
HOLDOUT = 5

_MASK = (1 << HASH_BITS) - 1
# ASCII letters in lower case and bytes above ASCII stay, all else parts words
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(data: bytes | None) -> np.ndarray:
    """The distinct hashed terms of a UTF-8 text, ascending."""
    if not data:
        return np.zeros(0, np.int64)
    words = set(data.translate(_TABLE).split())
    return np.unique(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & _MASK)


def _term_rows(batches):
    for b in batches:
        each = [terms(t.as_py()) for t in b.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([t.astype(np.int32) for t in each], pa.list_(pa.int32()))], names=["label", "terms"])


def held_out(id_col: str) -> Column:
    """Rows whose crc32 of the id as text leaves no rest by ``HOLDOUT``: never trained on."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(HOLDOUT)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(label, terms)`` of the bounded sample of labelled rows."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label")) \
        .where(~held_out("_id"))
    share = sample_rows / max(known.count(), 1)
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # about sample_rows rows of two numbers, by the sample's bound
    rows = src.join(F.broadcast(known), "_id").select("label", "text")
    return rows.mapInArrow(_term_rows, "label int, terms array<int>")


class Machine:
    """The fitted machine; a term that is not in ``selected`` weighs nothing."""

    def __init__(self, selected: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.selected, self.w0, self.w, self.v = selected, w0, w, v

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.selected, found)
        at = at[(at < len(self.selected)) & (self.selected[np.minimum(at, len(self.selected) - 1)] == found)] if len(self.selected) else at[:0]
        z = self.w0
        if len(at):
            v = self.v[at]
            s = v.sum(axis=0)
            z += float(self.w[at].sum() + 0.5 * (s @ s - (v * v).sum()))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class _Design:
    """Rows of term numbers as a scaled 0/1 matrix: products with it and with its transpose."""

    def __init__(self, rows: list[np.ndarray], n_terms: int):
        self.n, self.n_terms = len(rows), n_terms
        self.at = np.concatenate(rows)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        with_term = np.bincount(self.at, minlength=n_terms)
        # a term of every row is the intercept once more
        self.scale = np.sqrt((1 - with_term / self.n) / (with_term + PRIOR_ROWS))
        self.x = self.scale[self.at]
        self.squares = self.x * self.x

    def rows_of(self, v: np.ndarray) -> np.ndarray:
        if v.ndim > 1:
            return np.stack([self.rows_of(c) for c in v.T], axis=1)
        return np.bincount(self.row, v[self.at] * self.x, self.n)

    def terms_of(self, e: np.ndarray) -> np.ndarray:
        if e.ndim > 1:
            return np.stack([self.terms_of(c) for c in e.T], axis=1)
        return np.bincount(self.at, e[self.row] * self.x, self.n_terms)

    def own(self, e: np.ndarray) -> np.ndarray:
        """What a term's product with itself adds: no interaction."""
        return np.bincount(self.at, e[self.row] * self.squares, self.n_terms)[:, None]

    def pairs(self, v: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return 0.5 * ((sums * sums).sum(axis=1) - np.bincount(self.row, (v * v).sum(axis=1)[self.at] * self.squares, self.n))


def _interactions(d: _Design, err: np.ndarray, k: int, rng) -> tuple[np.ndarray, float]:
    """The ``k`` strongest directions in which pairs of terms explain the errors, and the strength of the first."""
    own = d.own(err)
    v = np.linalg.qr(rng.normal(size=(d.n_terms, k)))[0]
    strength = 0.0
    for _ in range(8):
        w = own * v - d.terms_of(err[:, None] * d.rows_of(v))
        strength = float(np.linalg.eigvalsh((v.T @ w + w.T @ v) / 2)[-1])
        v = np.linalg.qr(w)[0]
    return v, strength


def _shrunk(u: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(u) * np.maximum(np.abs(u) - by, 0)


def _fit(rows: list[np.ndarray], y: np.ndarray, n_terms: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Accelerated proximal steps for the weights, then plain ones for weights
    and factors; rows hold the numbers of their terms."""
    rng = np.random.default_rng(SEED)
    k = min(FACTORS, n_terms)
    if not n_terms:
        return float(np.log(y.mean() / (1 - y.mean()))), np.zeros(0), np.zeros((0, FACTORS))
    d = _Design(rows, n_terms)
    each = np.where(y > 0, np.sqrt((1 - y.mean()) / y.mean()), 1.0)  # the rarer kind counts more
    each /= each.mean()

    def errors(z):
        return (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * each

    share = (each * y).sum() / each.sum()
    w0 = float(np.log(share / (1 - share)))
    chance = max(float(np.abs(d.terms_of(rng.permutation((share - y) * each))).max()) for _ in range(3))
    steep = rng.normal(size=n_terms)
    for _ in range(8):
        steep = d.terms_of(each * d.rows_of(steep / np.linalg.norm(steep)))
    rate, rate0 = 2 / max(float(np.linalg.norm(steep)), 1e-9), 2 / each.sum()

    u, penalty = np.zeros(n_terms), np.full(n_terms, EASE * chance)
    for _ in range(2):
        before, t = u, 1.0
        for _ in range(STEPS):
            t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            ahead = u + (last - 1) / t * (u - before)
            e = errors(w0 + d.rows_of(ahead))
            w0 -= rate0 * float(e.sum())
            before, u = u, _shrunk(ahead - rate * d.terms_of(e), rate * penalty)
        penalty = np.where(u != 0, 0.1, 1.0) * EASE * chance

    v = np.zeros((n_terms, k))
    left = errors(w0 + d.rows_of(u))
    start, strength = _interactions(d, left, k, rng)
    null = max(_interactions(d, rng.permutation(left), 2 if k > 1 else 1, rng)[1] for _ in range(2))
    if strength > null > 0:
        v, pace = 0.3 * start, 0.5 / (strength + null)
        kept, least = (w0, u, v), np.inf
        for _ in range(2 * STEPS):
            sums = d.rows_of(v)
            z = w0 + d.rows_of(u) + d.pairs(v, sums)
            cost = float((each * np.logaddexp(0, np.where(y > 0, -z, z))).sum() + (penalty * np.abs(u)).sum() + null / 2 * (v * v).sum())
            if cost > least:  # too far: back, and on by half
                w0, u, v = kept
                pace, rate, rate0, least = pace / 2, rate / 2, rate0 / 2, np.inf
                continue
            kept, least, e = (w0, u, v), cost, errors(z)
            w0 = w0 - rate0 * float(e.sum())
            u = _shrunk(u - rate * d.terms_of(e), rate * penalty)
            v = v - pace * (d.terms_of(e[:, None] * sums) - d.own(e) * v + null * v)
        w0, u, v = kept
    return w0, u * d.scale, np.pad(v * d.scale[:, None], ((0, 0), (0, FACTORS - k)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Machine:
    sample = training_rows(docs, labels, id_col, text_col, label_col, sample_rows).cache()
    try:
        total = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
        n, toxic = int(total[0]), int(total[1])
        none = np.zeros(0)
        if not toxic or toxic == n:
            share = toxic / n if n else 0.0
            return Machine(none.astype(np.int64), 30.0 if share else -30.0, none, np.zeros((0, FACTORS)))
        # at most sample_rows arrays of distinct terms
        rows = sample.select("label", "terms").toArrow()
    finally:
        sample.unpersist()
    found = [t.values.to_numpy() for t in rows["terms"]]
    y = rows["label"].to_numpy().astype(float)
    every = np.unique(np.concatenate(found)).astype(np.int64)
    places = [np.searchsorted(every, t) for t in found]
    # a fixed order, whatever task came first
    order = sorted(range(len(places)), key=lambda i: (y[i], places[i].tobytes()))
    w0, w, v = _fit([places[i] for i in order], y[order], len(every))
    some = (w != 0) | (v != 0).any(axis=1)
    return Machine(every[some], w0, w[some], v[some])


def score_documents(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.selected, machine.w0, machine.w, machine.v))

    def run(batches):
        model = Machine(*shared.value)
        for b in batches:
            scores = np.array([model.score(terms(t.as_py())) for t in b.column(2).cast(pa.binary())], float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    return score_documents(docs, train(docs, labels, id_col, text_col, label_col, sample_rows), id_col, text_col)
