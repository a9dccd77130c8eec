"""Language identification by Bayesian evidence fusion.

For every language ``l`` of ``LANGUAGES`` and for ``other`` (no known language):

    log posterior = log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host)

* Text: a second-order Markov chain over 64 character classes per language,
  counted over all rows whose declared language is known; ``other`` draws all
  letters alike. The counts are one grouped aggregate, bounded by
  languages x 64**3 whatever the corpus.
* Declared markup language and address suffix: likelihood tables, grouped
  aggregates of the text posteriors (soft counts) over the whole corpus. A
  missing declaration or suffix is no evidence.
* Host prior, smoothed hierarchically: a host's soft counts on top of
  ``STRENGTH`` pseudo-rows of its domain's distribution, and that on top of as
  many of the whole corpus'. A row's own text is taken out of its host's
  counts, so no evidence counts twice.

The text is read in two narrow passes and never shuffled; the tables of
domains, hosts and suffixes are joined by salted lookups, so one hot host
spreads over many tasks.

A row is accepted where ``other`` has less than half of the posterior; its
language is then the likeliest known one, be it a close call.

Edge cases: null and empty texts, and texts without letters, carry no text
evidence and are not accepted (language null); null hosts, suffixes and
declarations are no evidence; repeated rows each give a row; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import hot_keys, lookup_join, materialize, sealed

LANGUAGES = ("de", "en", "es", "fr")
STRENGTH = 20.0
#: A row is accepted where the known languages together have this much posterior.
MIN_KNOWN = 0.5
#: Pseudo-count of a transition, and of an entry of the evidence tables.
ALPHA = 0.05
PSEUDO = 0.5

# 64 character classes of UTF-8 bytes: 0 anything ASCII but a letter, 1-26 the
# letters, the bytes above ASCII on the other 37.
_CLASS = np.zeros(256, np.uint32)
for _b in range(26):
    _CLASS[ord("a") + _b] = _CLASS[ord("A") + _b] = 1 + _b
_CLASS[128:] = 27 + np.arange(128) % 37


def _trigrams(data: bytes) -> np.ndarray:
    """Codes of three classes in a row that hold a letter, from `` text ``."""
    c = _CLASS[np.frombuffer(b" " + data + b" ", np.uint8)]
    code = (c[:-2] << 12) | (c[1:-1] << 6) | c[2:]
    return code[(c[1:-1] > 0) | (c[2:] > 0)] if len(data) else code[:0]


def _count(batches):
    """Trigram counts of the rows of a task, by language."""
    total = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
            have = total.setdefault(lang, np.zeros(1 << 18, np.int64))
            codes = _trigrams(text.as_py() or b"")
            if len(codes) > 4096:
                have += np.bincount(codes, minlength=1 << 18)
            else:
                np.add.at(have, codes, 1)
    for lang, have in total.items():
        codes = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.astype(np.int32)), pa.array(have[codes])],
                                         names=["lang", "code", "n"])


def train_text_model(labelled: DataFrame, languages=LANGUAGES) -> np.ndarray:
    """Log transition probabilities, ``(languages + 1) x 64**3`` (the last row:
    ``other``), of ``labelled(lang, text)``."""
    rows = labelled.where(F.col("lang").isin(*languages)).select("lang", F.col("text").cast("string").alias("text")) \
        .mapInArrow(_count, "lang string, code int, n long") \
        .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()  # at most languages x 64**3 rows
    model = np.zeros((len(languages) + 1, 1 << 18), np.float32)
    for k, lang in enumerate(languages):
        n = np.full(1 << 18, ALPHA)
        own = rows[rows["lang"] == lang]
        np.add.at(n, own["code"].to_numpy(np.int64), own["n"].to_numpy(np.float64))
        n = n.reshape(4096, 64)
        model[k] = np.log(n / n.sum(axis=1, keepdims=True)).ravel()
    model[-1] = -np.log(28.0)  # a letter or a break, all alike
    return model


def _likelihood(model):
    """Adds ``_ll`` (log P(text | l) per language) and ``_n`` (trigrams) in place of the text."""
    value = model.value if hasattr(model, "value") else model

    def run(batches):
        table = np.ascontiguousarray(value.T)
        for b in batches:
            ll, n = [], []
            for text in b.column(b.num_columns - 1).cast(pa.binary()):
                codes = _trigrams(text.as_py() or b"")
                score = np.zeros(table.shape[1])
                for at in range(0, len(codes), 1 << 16):
                    score += table[codes[at:at + (1 << 16)]].sum(axis=0, dtype=np.float64)
                ll.append(score)
                n.append(len(codes))
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(ll, pa.list_(pa.float64())), pa.array(n, pa.int64())],
                names=[*b.schema.names[:-1], "_ll", "_n"])
    return run


def _softmax(log: Column) -> Column:
    top = F.array_max(log)
    e = F.transform(log, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _sums(n: int) -> list[Column]:
    return [F.sum(F.get("_post", F.lit(k))).alias(f"_c{k}") for k in range(n)]


def _counts(n: int) -> Column:
    return F.array(*[F.col(f"_c{k}") for k in range(n)])


def identify(rows: DataFrame, model: np.ndarray, keep: list[str], languages=LANGUAGES,
             min_known: float = MIN_KNOWN) -> DataFrame:
    """``keep`` plus ``language`` (null: none), ``posterior``, ``text_language``
    and ``accepted`` for each row of ``rows(*keep, declared, suffix, domain,
    host, text)``."""
    k = len(languages) + 1
    spark = rows.sparkSession
    names = ["declared", "suffix", "domain", "host"]
    renamed = rows.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                          *[F.col(c).cast("string").alias(f"_{c}") for c in names], F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in renamed.schema.fields[:-1]) + ", _ll array<double>, _n long"
    shared = spark.sparkContext.broadcast(model)  # (languages + 1) x 64**3 floats
    r = renamed.mapInArrow(_Scorer(shared), schema)
    flat = F.array(*[F.lit(1.0 / k)] * k)
    r = materialize(r.withColumn("_post", F.when(F.col("_n") > 0, _softmax(F.col("_ll"))).otherwise(flat))
                    .withColumn("_spread", F.xxhash64(*[f"_k{i}" for i in range(len(keep))])), "langid")
    seen = r.where("_n > 0")

    whole = seen.agg(*_sums(k), F.count(F.lit(1)).alias("n")).first()
    total = sum((whole[i] or 0.0) for i in range(k)) + k * PSEUDO
    corpus_share = [((whole[i] or 0.0) + PSEUDO) / total for i in range(k)]
    corpus = F.array(*map(F.lit, corpus_share))

    def mixed(counts: Column, parent: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
        return F.zip_with(counts, parent, lambda c, p: (F.greatest(c, F.lit(0.0)) + STRENGTH * p) / (size + STRENGTH))

    # host prior: corpus -> domain -> host
    domains = seen.where("_domain is not null").groupBy("_domain").agg(*_sums(k)) \
        .select("_domain", _counts(k).alias("_dc"))
    hosts = seen.where("_host is not null").groupBy("_host").agg(*_sums(k), F.count(F.lit(1)).alias("_hn"), F.max("_domain").alias("_domain")) \
        .select("_host", "_hn", "_domain", _counts(k).alias("_hc"))
    hosts = materialize(hosts.join(domains, "_domain", "left")
                        .select("_host", "_hn", "_hc", F.coalesce(mixed(F.col("_dc"), corpus), corpus).alias("_dp")), "langid-host")
    total_rows = int(whole["n"] or 0)
    out = lookup_join(r, hosts.select("_host", "_hc", "_dp"), "_host", hot_keys(hosts, "_host", "_hn", total_rows), F.col("_spread"))

    # P(suffix | l)
    suffixes = seen.where("_suffix is not null").groupBy("_suffix").agg(*_sums(k), F.count(F.lit(1)).alias("_sn"))
    suffixes = materialize(suffixes.select("_suffix", "_sn", _counts(k).alias("_sc")), "langid-suffix")
    of_suffix = suffixes.agg(*[F.sum(F.get("_sc", F.lit(i))) for i in range(k)], F.count(F.lit(1))).first()
    width = of_suffix[k]
    weight = suffixes.select("_suffix", "_sn", F.array(*[
        F.log((F.get("_sc", F.lit(i)) + PSEUDO) / F.lit((of_suffix[i] or 0.0) + PSEUDO * max(width, 1))) for i in range(k)]).alias("_sl"))
    out = lookup_join(out, weight.select("_suffix", "_sl"), "_suffix", hot_keys(weight, "_suffix", "_sn", total_rows), F.col("_spread"))

    # P(declared | l): known languages and one class for all others, a table of k x k
    said = F.when(F.col("_declared").isin(*languages), F.col("_declared")).when(F.col("_declared").isNotNull(), F.lit("?"))
    table = {x["said"]: x for x in seen.select(said.alias("said"), "_post").where("said is not null").groupBy("said").agg(*_sums(k)).collect()}
    counts = np.array([[(table[w][f"_c{i}"] if w in table else 0.0) for i in range(k)] for w in (*languages, "?")]) + PSEUDO
    declared = np.log(counts / counts.sum(axis=0))

    names = [f"_k{i}" for i in range(len(keep))]
    kinds = {f.name: f.dataType.simpleString() for f in r.schema.fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", language string, posterior double, text_language string, accepted boolean"
    fused = out.select(*names, said.alias("_said"), "_n", "_ll", "_hc", "_dp", "_sl") \
        .mapInArrow(_fuse(len(names), languages, corpus_share, declared, min_known), schema)
    return fused.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "language", "posterior", "text_language", "accepted")


def _matrix(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column of width ``k`` as a matrix (zero rows for nulls), and which rows are there."""
    there = np.asarray(column.is_valid())
    out = np.zeros((len(column), k))
    out[there] = np.asarray(column.flatten()).reshape(-1, k)
    return out, there


def _soft(log: np.ndarray) -> np.ndarray:
    e = np.exp(log - log.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fuse(width: int, languages, corpus: list[float], declared: np.ndarray, min_known: float):
    """All evidence of a batch of rows, added up: ``log P`` of text, declaration,
    suffix, and the smoothed host prior without the row's own text."""
    tags, rows = np.array([*languages, "other"], dtype=object), {w: i for i, w in enumerate((*languages, "?"))}

    def run(batches):
        k = len(tags)
        for b in batches:
            said, n, ll, hc, dp, sl = (b.column(width + i) for i in range(6))
            n = n.to_numpy()
            ll, _ = _matrix(ll, k)
            text = _soft(ll)
            counts, hosted = _matrix(hc, k)
            parent, _ = _matrix(dp, k)
            others = np.maximum(counts - np.where(n[:, None] > 0, text, 0), 0)
            prior = np.where(hosted[:, None], (others + STRENGTH * parent) / (others.sum(axis=1, keepdims=True) + STRENGTH), np.array(corpus))
            told = np.array([declared[rows[w]] if w is not None else np.zeros(k) for w in said.to_pylist()]).reshape(-1, k)
            final = _soft(ll + told + _matrix(sl, k)[0] + np.log(prior))
            best = final[:, :-1].argmax(axis=1)
            ok = (n > 0) & (1 - final[:, -1] >= min_known)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], pa.array(np.where(ok, tags[best], None), pa.string()), pa.array(np.round(final[np.arange(len(best)), best], 6)),
                 pa.array(np.where(n > 0, tags[text.argmax(axis=1)], None), pa.string()), pa.array(ok)],
                names=[*b.schema.names[:width], "language", "posterior", "text_language", "accepted"])
    return run


class _Scorer:
    """The likelihood pass; the model travels as a broadcast."""

    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batches):
        return _likelihood(self.shared)(batches)


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
                  host_col: str | None = "source") -> DataFrame:
    """Documents as input of ``identify``: the language column is the
    declaration, the source stands for the host (and is its own domain)."""
    null = F.lit(None).cast("string")
    declared = F.lower(F.col(lang_col)) if lang_col else null
    host = F.col(host_col).cast("string") if host_col else null
    return docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("long").alias("page_id"), declared.alias("declared"),
                       null.alias("suffix"), host.alias("domain"), host.alias("host"), F.col(text_col).alias("text"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as input of ``identify``: markup language, address suffix,
    registered domain (the last two labels), host and the visible text."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#a-zA-Z0-9]+;", " ")
    return pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", F.when(declared != "", declared).alias("declared"),
                        F.element_at(F.split(host, r"\."), -1).alias("suffix"),
                        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), host.alias("host"), text.alias("text"))


def identify_documents(docs: DataFrame, pages: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", host_col: str | None = "source") -> DataFrame:
    """Trains on ``docs`` and identifies them, and ``pages`` too if given: one
    row each, named by ``doc_id`` or ``page_id``."""
    rows = document_rows(docs, id_col, text_col, lang_col, host_col)
    model = train_text_model(rows.select(F.col("declared").alias("lang"), "text"))
    return identify(rows if pages is None else rows.unionByName(page_rows(pages)), model, ["doc_id", "page_id"])


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    host_col: str | None = "source") -> DataFrame:
    """``docs`` without the rows whose language is not accepted. A row is named
    by its id and a hash of what it is judged by, so only full copies share a fate."""
    src, (id_col, text_col, lang_col, host_col), restore = sealed(docs, id_col, text_col, lang_col, host_col)
    judged = [F.md5(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))) for c in (text_col, lang_col, host_col) if c]
    key = F.concat_ws(" ", F.col(id_col).cast("string"), F.md5(F.concat(*judged)))
    keyed = src.withColumn("_key", key)
    rows = document_rows(keyed, "_key", text_col, lang_col, host_col)
    model = train_text_model(rows.select(F.col("declared").alias("lang"), "text"))
    found = identify(rows, model, ["doc_id"])
    drop = found.where(~F.col("accepted")).select(F.col("doc_id").alias("_key")).distinct()
    return restore(keyed.join(drop, "_key", "left_anti"))
