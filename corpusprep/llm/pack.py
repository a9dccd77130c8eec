"""Best-fit packing by a configuration linear program over the length histogram.

1. One Arrow pass tokenizes every text, appends the end id and cuts only texts
   longer than a sequence (into full pieces; the first piece is the short one).
2. The histogram of piece lengths (at most ``capacity`` rows) goes to the
   driver. A *configuration* is a multiset of lengths that fits a sequence; the
   linear program covers the histogram with the fewest configurations.
   Multiplicative weights hold a price per length; each round a knapsack
   dynamic program over the capacity prices, for every length, the best
   configuration holding it. Lengths served ahead of their demand get
   cheaper, the others dearer.
3. Rounding: configurations are used in whole copies, heaviest first, as far as
   the histogram has their lengths; what is left is solved again, as long as sequences
   fill well; for the rest the shortest of several plans is taken (the program
   once more, best fit by descending length, or one sequence after the other
   around its largest piece). Counts are scaled down first, so that the steps
   do not depend on them (:func:`solve`).
4. Pieces of one length are interchangeable: a running count numbers them, and
   number ``r`` of length ``l`` takes the ``r``-th slot of that length in the
   list of configurations. No task ever holds a bin's or a length's pieces
   as a whole; the slot list's size depends on ``capacity`` and the rounds only.

Edge cases: null and empty texts are one piece, the end id alone; repeated rows
are packed each; null ids are kept; an empty table gives no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import chained_sum, materialize, shuffle_partitions

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights per solve, their step, and most solves of one scale.
ROUNDS = 24
STEP = 0.5
SOLVES = 12
#: Pieces that the program is solved for at once; larger histograms are scaled down to it.
SCALE = 1 << 16
BUCKETS = 512


# ---------------------------------------------------------------- tokens

@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """Text -> ids of a byte-level BPE tokenizer file.

    The file's own library is the definition; the same vocabulary as ranks
    gives the same ids several times faster, so it is used for all texts
    that do not spell a special token, once it has agreed with the library
    on probe strings.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    specials = [t["content"] for t in spec.get("added_tokens", [])]

    def exact(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    # byte-level vocabularies spell each byte as a printable character: the
    # printable Latin-1 bytes as themselves, the others from U+0100 on in order
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spelled = {chr(b): b for b in plain}
    spelled.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    ranks = {bytes(spelled[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in specials}
    import public_tokenizers
    fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    probes = ["", "a", " a  b\n\n c\t", "Don't they're 12345 x1y2", "Größe élève 日本語 \U0001f600!!", "a" * 70, "--== {}\r\n_x"]
    if any(fast.encode_ordinary(p) != exact(p) for p in probes):
        return exact
    return lambda text: exact(text) if any(s in text for s in specials) else fast.encode_ordinary(text)


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        encode = _encoder(path)
        for b in batches:
            rows, ids = [], []
            for name, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                got = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                first = (len(got) - 1) % capacity + 1
                cuts = [0, *range(first, len(got) + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = got[a:z]
                    rows.append((name, k, a, z - a, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            cols = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
            out = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids]``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return src.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids), schema)


# ---------------------------------------------------------------- the program

def _knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total price within each capacity, and the length to place first (0: none)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        best[c], take[c] = best[c - 1], 0 if take[c - 1] == 0 else -1
        usable = lengths[:np.searchsorted(lengths, c, side="right")]
        if len(usable):
            value = price[usable] + best[c - usable]
            k = int(np.argmax(value))
            if value[k] > best[c]:
                best[c], take[c] = value[k], usable[k]
    # -1: as one capacity less; resolve to (where, what)
    at = np.arange(capacity + 1)
    for c in range(1, capacity + 1):
        if take[c] == -1:
            at[c] = at[c - 1]
    return best, np.stack([at, np.where(take > 0, take, 0)])


def _configurations(demand: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = STEP) -> dict[tuple, float]:
    """Fractional cover: configuration (lengths, descending) -> how often to use it."""
    lengths = np.flatnonzero(demand)
    price = np.arange(capacity + 1, dtype=float) / capacity
    served = np.zeros(capacity + 1)
    use: dict[tuple, float] = defaultdict(float)
    for t in range(1, rounds + 1):
        best, (at, take) = _knapsack(price, lengths, capacity)
        room, items = capacity - lengths, [lengths]
        while True:
            where = at[room]
            item = take[where]
            if not item.any():
                break
            items.append(item)
            room = where - item
        table = -np.sort(-np.stack(items, axis=1), axis=1)
        value = price[lengths] + best[capacity - lengths]
        own = (table == lengths[:, None]).sum(axis=1)
        open_demand = np.maximum(0.0, demand[lengths] * t / rounds - served[lengths])
        # only near-best columns are the oracle's answer, or those that the last rounds still lack
        good = (value >= (1 - 0.02) * value.max()) | (t > rounds // 2)
        amount = np.where(good, open_demand / own, 0.0)
        for row, x in zip(table[amount > 0], amount[amount > 0], strict=True):
            # large pieces lead; what they fill is not led again in this round
            top = row[0]
            lack = demand[top] * t / rounds - served[top]
            if lack <= 0:
                continue
            x = min(x, lack)
            row = tuple(int(v) for v in row if v)
            use[row] += x
            for v in row:
                served[v] += x
        with np.errstate(divide="ignore", invalid="ignore"):
            ahead = np.where(demand > 0, served / (demand * t / rounds) - 1, 0.0)
        less = step * np.clip(ahead, -1, 2) / np.sqrt(t)
        price *= (1 - less / 2) / (1 + less / 2)  # close to exp(-less), and exactly rounded everywhere
        price[lengths] /= (price[lengths] + best[capacity - lengths]).max()
    return use


def _fill(left: np.ndarray, capacity: int) -> tuple:
    """The largest piece left, and the subset of the others that fills its sequence best."""
    top = int(np.flatnonzero(left)[-1])
    left[top] -= 1
    room = capacity - top
    reach, marks, items = 1, [1], []
    mask = (1 << (room + 1)) - 1
    small = np.flatnonzero(left[:room + 1])[::-1]
    for length in small:
        for _ in range(min(int(left[length]), room // int(length))):
            reach |= (reach << int(length)) & mask
            marks.append(reach)
            items.append(int(length))
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    goal, chosen = reach.bit_length() - 1, [top]
    for k in range(len(items), 0, -1):
        if not marks[k - 1] >> goal & 1:
            chosen.append(items[k - 1])
            left[items[k - 1]] -= 1
            goal -= items[k - 1]
    return tuple(sorted(chosen, reverse=True))


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Pieces by descending length, each into the fullest sequence that still has room."""
    open_: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # by room
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        for _ in range(int(left[length])):
            fits = np.flatnonzero(rooms[length:])
            room = length + int(fits[0]) if len(fits) else capacity
            config = open_[room].pop() if len(fits) else []
            rooms[room] = bool(open_[room])
            config.append(length)
            open_[room - length].append(config)
            rooms[room - length] = room > length
    count: dict[tuple, int] = defaultdict(int)
    for configs in open_:
        for c in configs:
            count[tuple(c)] += 1
    return sorted(count.items())


def _fill_all(left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """One sequence after the other, each around the largest piece left."""
    left, plan = left.copy(), []
    while left.any():
        config = _fill(left, capacity)
        plan.append((config, 1 + _use(left, config, None)))  # again, while all its lengths are there
    return plan


def _use(left: np.ndarray, config: tuple, most: int | None) -> int:
    """Takes a configuration off the histogram as often as it has the pieces, at most ``most`` times."""
    need = np.bincount(config, minlength=len(left))
    held = np.flatnonzero(need)
    copies = int((left[held] // need[held]).min())
    copies = copies if most is None else min(copies, most)
    left[held] -= copies * need[held]
    return copies


def _rounded(left: np.ndarray, capacity: int, slack: int) -> list[tuple[tuple, int]]:
    """Solves the program for ``left`` and takes whole copies of its
    configurations off it, fullest first, down to ``slack`` tokens unused."""
    plan = []
    use = _configurations(left.astype(float), capacity)
    for config, x in sorted(use.items(), key=lambda kv: (-sum(kv[0]), -kv[1], kv[0])):
        if capacity - sum(config) > slack:
            break  # leave what fills badly to the next solve
        copies = _use(left, config, int(np.ceil(x)))
        if copies:
            plan.append((config, copies))
    return plan


def _tail(left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """What whole copies left over: the shortest of several plans."""
    plans = [_fill_all(left, capacity), _best_fit(left, capacity)]
    for slack in (0, capacity // 100, capacity // 10):
        rest = left.copy()
        start = _rounded(rest, capacity, slack)
        plans += [start + _best_fit(rest, capacity), start + _fill_all(rest, capacity)]
    return min(plans, key=lambda p: sum(copies for _, copies in p))


def _solve_scaled(left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Takes off ``left``, a histogram of at most ``SCALE`` pieces, what the program
    fills well in whole copies, as long as it finds such."""
    plan: list[tuple[tuple, int]] = []
    for _ in range(SOLVES):
        placed = _rounded(left, capacity, capacity // 400) if left.any() else []
        plan += placed
        if sum(copies * len(config) for config, copies in placed) * 10 < left.sum():
            break
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """``(configuration, copies)`` that hold exactly ``histogram``'s pieces.

    Counts of any size are scaled down: a plan for ``left // scale`` is used
    ``scale`` times; what it does not fill well, and what the division leaves,
    is planned again with the smaller scale that it needs, down to 1. Only there,
    or where most pieces of a scale fill no sequence well, is the rest packed as it comes. All
    sizes take the same steps, and every step is made of exactly rounded
    operations (no exponentials), so a histogram has one plan on every machine.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[int(length)] = n
    plan: list[tuple[tuple, int]] = []
    if left[capacity]:
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    while left.any():
        scale = -(-int(left.sum()) // SCALE)
        part = left // scale
        left -= part * scale
        whole = part.copy()
        own = _solve_scaled(part, capacity)
        if scale == 1 or 2 * part.sum() > whole.sum():
            own += _tail(part, capacity) if part.any() else []
            own = min(own, _tail(whole, capacity), key=lambda p: sum(copies for _, copies in p))
        else:
            left += part * scale
        plan += [(config, copies * scale) for config, copies in own]
    return plan


def _slots(plan, capacity: int):
    """Per length, in order: first rank, first sequence and offset of each run of slots."""
    runs = defaultdict(list)
    ranks = np.zeros(capacity + 1, np.int64)
    base = 0
    for config, copies in plan:
        at = 0
        for length in config:
            runs[length].append((ranks[length], base, at))
            ranks[length] += copies
            at += length
        base += copies
    lengths = sorted(runs)
    rows = [(length, *r) for length in lengths for r in runs[length]]
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4


def _place(slots):
    """Length and rank -> sequence and offset, by binary search in the slot list."""
    length, first, base, at = slots
    key = length * (1 << 50) + first

    def run(batches):
        for b in batches:
            own = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy()
            k = np.searchsorted(key, own * (1 << 50) + rank, side="right") - 1
            cols = [b.column(i) for i, n in enumerate(b.schema.names) if n != "_rank"]
            names = [n for n in b.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(base[k] + rank - first[k]), pa.array(at[k])],
                                             names=[*names, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    pieces = materialize(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    slots = _slots(solve(histogram, capacity), capacity)
    key = [F.xxhash64("doc_id", "piece", "start", "ids_crc32")]
    buckets = max(BUCKETS, 8 * shuffle_partitions(docs.sparkSession))  # full pieces may be most of all: no length is few tasks
    bucket = F.pmod(key[0], F.lit(buckets)).cast("int")
    ranked = chained_sum(pieces.withColumn("_one", F.lit(1).cast("long")), ["length"], bucket, key, "_one", "_rank").drop("_one")
    names = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place(slots), schema)
