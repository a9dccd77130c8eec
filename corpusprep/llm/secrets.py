"""Secret scans over a trigram inverted index, in DataFrame functions only.

1. ``trigram_query`` derives from each rule's regex a Boolean query in
   disjunctive form: sets of (lower-cased) trigrams, one of which every match
   must contain in full. A rule without mandatory trigrams has none.
2. ``postings`` inverts the texts over the trigrams the rules ask for:
   ``(trigram, key)`` rows, ``key`` being a stable hash of id and text. A hash
   collision only adds a candidate.
3. ``candidates`` merges the postings of each clause by key and keeps the keys
   that have all of its trigrams.
4. ``secret_spans`` joins the candidates back and verifies: the rule's regex
   runs on its candidates only; rules without a query run on every text.

Spans are code point offsets, end exclusive: the lengths of the pieces between
matches and of the matches themselves, summed from the left.

Edge cases: a null text is an empty one; null ids are kept; repeated rows are
scanned each and give one row each; an empty table gives no rows; input columns
named like an output column are not touched (only id and text are read).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import sealed


@dataclass(frozen=True)
class Rule:
    """``least`` code points in ``group`` of a match, or the match is dropped
    (it still uses up its text)."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: The three base kinds, in the order in which spans of one start are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # the runs of 16 or more
)
#: Further public key formats.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)
RULES = BASE_RULES + MORE_RULES
#: A run of alternatives is cut where it would grow beyond so many strings.
MAX_STRINGS = 32
REDACTED = "[SECRET]"


def _and(a: set | None, b: set | None) -> set | None:
    """Conjunction of two queries (None: no condition), without clauses another one implies."""
    if a is None or b is None:
        return a if b is None else b
    return _least({x | y for x, y in product(a, b)})


def _least(clauses: set) -> set:
    return {c for c in clauses if not any(d < c for d in clauses)}


def _of_strings(strings: set[str]) -> set | None:
    """One clause per alternative string; none if some string is shorter than a trigram."""
    clauses = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in clauses else _least(clauses)


def _one(op, arg) -> tuple[set[str] | None, set | None]:
    """``(strings, query)`` of one regex node: all the strings it matches, if
    they are few, else a query that each of its matches meets."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}, None
    if op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 8:
        return {chr(c).lower() for _, c in arg}, None
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            strings = set().union(*(s for s, _ in parts))
            if len(strings) <= MAX_STRINGS:
                return strings, None
        queries = [q if s is None else _of_strings(s) for s, q in parts]
        return None, None if None in queries else _least(set().union(*queries))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and high == 1:
            return ({""} if low == 0 else set()) | strings, None
        if low == 0:
            return None, None
        return None, query if strings is None else _of_strings(strings)
    return None, None


def _sequence(nodes) -> tuple[set[str] | None, set | None]:
    run, query, finite = {""}, None, True
    for op, arg in nodes:
        strings, inner = _one(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        finite = False
        query = _and(query, _of_strings(run))
        run = {""} if strings is None else strings
        query = _and(query, inner)
    return (run, None) if finite else (None, _and(query, _of_strings(run)))


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Clauses of which every match of ``regex``, lower-cased, contains one in
    full; empty: no trigram is mandatory."""
    strings, query = _sequence(sre_parse.parse(regex))
    clauses = _of_strings(strings) if strings is not None else query
    return sorted(clauses or (), key=sorted)


def _clause_rows(rules) -> list[tuple[str, int, str, int, int]]:
    """``(kind, clause, trigram, bit, all bits)`` rows of all rules' queries."""
    rows, n = [], 0
    for r in rules:
        for clause in trigram_query(r.regex):
            grams = sorted(clause)[:62]  # a subset of a conjunction is still necessary
            rows += [(r.kind, n, g, 1 << i, (1 << len(grams)) - 1) for i, g in enumerate(grams)]
            n += 1
    return rows


def _key(df: DataFrame, id_col: str, text_col: str) -> Column:
    return F.xxhash64(df[id_col].cast("string"), df[text_col])


def postings(docs: DataFrame, grams: list[str], id_col: str, text_col: str) -> DataFrame:
    """``(trigram, key)``: the inverted index over ``grams``."""
    low = docs.select(_key(docs, id_col, text_col).alias("key"), F.lower(text_col).alias("low"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(hits).alias("trigram"))


def candidates(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, kinds)``: the rules whose trigram query a text meets."""
    rows = _clause_rows(rules)
    clauses = docs.sparkSession.createDataFrame(rows, "kind string, clause int, trigram string, bit long, full long")
    index = postings(docs, sorted({r[2] for r in rows}), id_col, text_col)
    return index.join(F.broadcast(clauses), "trigram") \
        .groupBy("key", "clause").agg(F.bit_or("bit").alias("has"), F.first("full").alias("full"), F.first("kind").alias("kind")) \
        .where("has = full").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _java(regex: str) -> str:
    return regex.replace(r"\x20", "[ ]")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(values: Column) -> Column:
    """A non-empty array in about as many runs as a run has entries."""
    width = F.ceil(F.sqrt(F.size(values))).cast("int")
    return F.transform(F.sequence(F.lit(1), F.size(values), width), lambda i: F.slice(values, i, width))


def _running(values: Column, add) -> Column:
    """Running totals by ``add`` (from 0) of a non-empty array of integers, in
    two levels: an append copies at most the root of the array's length."""
    def fold(part: Column, of) -> Column:
        return F.aggregate(part, F.array(F.lit(0)), lambda a, x: F.array_append(a, add(F.element_at(a, -1), of(x))))

    def join(runs: Column) -> Column:
        before = F.slice(fold(runs, lambda r: F.element_at(r, -1)), F.lit(1), F.size(runs))
        return F.flatten(F.zip_with(runs, before, lambda r, o: F.transform(F.slice(r, F.lit(2), F.size(r) - 1), lambda x: add(o, x))))

    return _bound(values, lambda v: _bound(F.transform(_parts(v), lambda p: fold(p, lambda x: x)), join))


def _placed(text: str, found: str, rule: Rule, rank: int) -> Column:
    """Spans of the kept matches in column ``found``: lengths summed from the left."""
    pattern = _java(rule.regex)
    gaps = F.split(F.col(text), pattern, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.col(found),
                       lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"),
                                             (F.length(F.regexp_extract(m, pattern, rule.group)) >= rule.least).alias("keep")))

    def spans(s: Column) -> Column:
        ends = _running(F.transform(s, lambda x: x["gap"] + x["len"]), lambda a, x: a + x)
        placed = F.zip_with(s, ends, lambda x, e: F.struct(x["keep"].alias("keep"), F.struct(
            (e - x["len"]).alias("start"), F.lit(rank).alias("rank"), e.alias("end")).alias("span")))
        return F.transform(F.filter(placed, lambda x: x["keep"]), lambda x: x["span"])

    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.when(F.size(found) > 0, _bound(steps, spans)).otherwise(empty)


def with_secret_spans(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
                      out: str = "secret_spans") -> DataFrame:
    """``docs`` (columns but id and text must not begin with ``_``) plus ``out``:
    array of ``(start, rank, end)`` by start, then rank (the rule's place in
    ``rules``)."""
    cols = docs.columns
    found = [f"_found{i}" for i in range(len(rules))]
    keyed = docs.withColumn("_key", _key(docs, id_col, text_col))
    cand = candidates(docs, rules, id_col, text_col).select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds"))
    joined = keyed.join(cand.hint("shuffle_hash"), "_key", "left") \
        .withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    none = F.array().cast("array<string>")

    def matches(rule: Rule) -> Column:
        run = F.regexp_extract_all("_text", F.lit(_java(rule.regex)), F.lit(0))
        if not trigram_query(rule.regex):
            return run  # no mandatory trigram: every text
        return F.when(F.array_contains("_kinds", F.lit(rule.kind)), run).otherwise(none)

    scanned = joined.withColumns({f: matches(r) for f, r in zip(found, rules, strict=True)})
    spans = F.array_sort(F.concat(*[_placed("_text", f, r, i) for i, (f, r) in enumerate(zip(found, rules, strict=True))]))
    return scanned.withColumn("_spans", spans).select(*[F.col(f"`{c}`") for c in cols], F.col("_spans").alias(out))


def span_text(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, digest of the base spans, all spans."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    s = with_secret_spans(src)
    base = F.filter("secret_spans", lambda x: x["rank"] < len(BASE_RULES))
    count = lambda i: F.size(F.filter("secret_spans", lambda x: x["rank"] == i)).cast("long")
    return s.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
                    F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secret_spans")).alias("spans"))


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", changed_col: str | None = None) -> DataFrame:
    """``docs`` with every span's text replaced by ``REDACTED`` (overlapping
    spans by one); rows without spans are as they were. ``changed_col`` is a
    further column that says which rows had spans."""
    if changed_col:
        docs = docs.withColumn(changed_col, F.lit(False))
    src, (id_col, text_col, changed), restore = sealed(docs, id_col, text_col, changed_col)
    s = with_secret_spans(src, id_col=id_col, text_col=text_col, out="_secret_spans")
    text = F.col(text_col)

    def run_of(run: Column) -> Column:
        """A run of spans: the text from its first ``pos`` on is cut out once, the pieces from that."""
        first, last = F.element_at(run, 1), F.element_at(run, -1)
        here = F.substring(text, first["pos"] + 1, F.greatest(last["pos"], last["start"]) - first["pos"])
        return _bound(here, lambda t: F.array_join(F.transform(run, lambda x: F.when(
            x["start"] >= x["pos"], F.concat(F.substring(t, x["pos"] - first["pos"] + 1, x["start"] - x["pos"]), F.lit(REDACTED)))
            .otherwise(F.lit(""))), ""))

    def redacted(ends: Column) -> Column:
        # pos: where the spans before this one end
        before = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))
        placed = F.zip_with("_secret_spans", before, lambda x, p: F.struct(x["start"].alias("start"), p.alias("pos")))
        runs = _bound(placed, lambda p: F.transform(_parts(p), run_of))
        return F.concat(F.array_join(runs, ""), F.substring(text, F.element_at(ends, -1) + 1, F.lit(2 ** 31 - 1)))

    cut = _bound(_running(F.transform("_secret_spans", lambda x: x["end"]), F.greatest), redacted)
    hit = F.size("_secret_spans") > 0
    out = s.withColumn(text_col, F.when(hit, cut).otherwise(text))
    return restore(out.withColumn(changed, hit) if changed else out)
