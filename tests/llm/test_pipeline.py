"""The pipeline against a brute-force version in plain Python."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusprep.llm import langid, mix, secrets
from tests_llm_brute import brute_components, brute_fingerprint

WORD = re.compile("[^ \t-\r]+")


def redact(text):
    spans = []
    for rank, r in enumerate(secrets.RULES):
        rx = re.compile(r.regex.replace("(?i:", "(?ai:"))
        spans += [(m.start(), rank, m.end()) for m in rx.finditer(text) if len(m.group(r.group)) >= r.least]
    out, at = "", 0
    for a, _, z in sorted(spans):
        if a >= at:
            out += text[at:a] + secrets.REDACTED
        at = max(at, z)
    return out + text[at:] if spans else text


def mixed(rows):
    """(id, text, source) rows -> the texts that the mix takes."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    targets, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        level = left / sum(weights[s] for s in open_)
        above = [s for s in open_ if 3 * sizes[s] < level * weights[s]]
        if not above:
            break
        for s in above:
            targets[s] = 3.0 * sizes[s]
            left -= targets[s]
            open_.remove(s)
    targets.update({s: level * weights[s] for s in open_})
    before, out = defaultdict(int), []
    for i, t, s in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}:{r[1]}".encode()).hexdigest()):
        n = len(WORD.findall(t))
        if not n:
            continue
        goal = int(targets[s] + 0.5)
        whole = goal // sizes[s]
        extra = max(0, min(n, goal - whole * sizes[s] - before[s]))
        before[s] += n
        out += [(i, t)] * whole
        if 2 * extra >= n:  # whole documents only
            out.append((i, t))
    return out


def pieces(i, text, tokenizer, capacity=2048):
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
    return [(i, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]


@pytest.fixture(scope="module")
def brute(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.source) for r in docs if re.search("[a-zA-Z\x80-\U0010ffff]", r.text or "")]
    comp = brute_components([(i, brute_fingerprint(t)) for i, t, _ in rows])
    rows = [r for r, c in zip(rows, comp, strict=True) if r[0] == c]
    rows = [(i, redact(t), s) for i, t, s in rows]
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    return Counter(p for i, t in mixed(rows) for p in pieces(i, t, tokenizer))


def test_run_against_brute_force(spark, brute):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert Counter(tuple(r)[:5] for r in rows) == brute
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_keep_the_columns_and_survive_odd_rows(tricky, shipped):
    docs = tricky
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(shipped, docs, "").cache()
        assert docs.columns == tricky.columns and docs.dtypes == tricky.dtypes, name
        assert docs.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](shipped, docs, "").count() >= docs.count()


def test_stages_take_empty_tables(empty, shipped):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(shipped, docs, "")
        assert docs.count() == 0
        docs = empty


def test_extra_columns_stay(tricky, shipped):
    from pyspark.sql import functions as F
    extra = tricky.withColumn("size", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("component_id", F.lit(2)).withColumn("language", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(shipped, extra, "")
        assert out.columns == extra.columns, name
        assert {(r.size, r.key, r.component_id, r.language) for r in out.collect()} == {("mine", 1, 2, "x")}, name


def test_mix_and_language_parameters():
    assert mix.WEIGHTS == (1, 2, 3) and mix.MAX_REPEATS == 3 and set(langid.LANGUAGES) == {"de", "en", "es", "fr"}
