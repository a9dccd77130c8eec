import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import mix

WORD = re.compile("[^ \t-\r]+")


def oracle(frame: pd.DataFrame) -> dict:
    con = duckdb.connect()
    con.register("documents", frame)
    rows = con.sql(mix.ORACLE_SQL).fetchall()
    return rows


def test_report_against_sql(tricky, tricky_rows):
    rows = [r for r in tricky_rows if r[0] is not None]
    df = tricky.where("doc_id is not null")
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "int64"})
    want = sorted(oracle(frame), key=str)
    got = sorted((tuple(r) for r in mix.mix_report(df).collect()), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    # full copies of a row may take each other's place
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    single = {i for i, *_ in got} - {99, 100}
    assert [g for g in got if g[0] in single] == [w for w in want if w[0] in single]


def test_targets_and_takes(tricky, tricky_rows):
    got = mix.mix_report(tricky).collect()
    assert len(got) == len(tricky_rows)
    sizes = defaultdict(int)
    for r in tricky_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    total = sum(sizes.values())
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    targets, open_, left = {}, set(sizes), float(total)
    while True:
        level = left / sum(weights[s] for s in open_)
        above = [s for s in open_ if 3 * sizes[s] < level * weights[s]]
        if not above:
            break
        for s in above:
            targets[s] = 3.0 * sizes[s]
            left -= targets[s]
            open_.remove(s)
    targets.update({s: level * weights[s] for s in open_})
    source = {}
    for r in tricky_rows:
        source.setdefault(r[0], set()).add(r[3])
    took = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id is not None:
            (s,) = source[r.doc_id]
            took[s] += r.taken
            assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s], rel=1e-12)
    for r in got:  # null ids carry their source in its sizes
        if r.doc_id is None:
            (s,) = [s for s in sizes if sizes[s] == r.source_size and targets[s] == pytest.approx(r.target)][:1]
            took[s] += r.taken
    for s in sizes:
        assert abs(took[s] - targets[s]) <= 1
    assert sorted(map(tuple, mix.mix_report(tricky.repartition(9)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_positions_invert_the_schedules():
    for knots in mix.SCHEDULES:
        area = sum((t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False))
        assert area > 0 and knots[0][0] == 0 and knots[-1][0] == 1


def test_stream_follows_the_report(tricky, tricky_rows):
    """Whole texts only; as often as the report's words say, to the nearest copy."""
    report = mix.mix_report(tricky).collect()
    stream = mix.mix_documents(tricky)
    assert stream.columns == tricky.columns
    rows = Counter((r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in stream.collect())
    known = {(r[0], r[1], r[3], r[2], r[4]) for r in tricky_rows}
    assert rows.keys() <= known  # no text is cut
    copies = Counter()
    for (doc_id, *_), n in rows.items():
        copies[doc_id] += n
    want = Counter()
    for r in report:
        if r.size and r.doc_id is not None:
            want[r.doc_id] += (2 * r.taken + r.size) // (2 * r.size)
    assert {k: v for k, v in copies.items() if k is not None} == {k: v for k, v in want.items() if v}
    assert max(rows.values()) <= 2 * mix.MAX_REPEATS  # a row may stand in the table twice


def test_reruns_agree_on_null_and_repeated_ids(shipped):
    """Rows that share an id, or have none, differ in text and size: whatever the
    partitioning, the same rows are taken."""
    rows = [(7 if i % 3 else None, " ".join(f"w{i}x{j}" for j in range(1 + i * 7 % 11)), f"s{i % 4}") for i in range(900)]
    df = shipped.createDataFrame(rows, "doc_id long, text string, source string")
    reports, streams = [], []
    for n in (1, 5, 13):
        part = df.repartition(n, F.rand(n))
        reports.append(Counter(map(tuple, mix.mix_report(part).collect())))
        streams.append(Counter(map(tuple, mix.mix_documents(part).collect())))
    assert reports[0] == reports[1] == reports[2]
    assert streams[0] == streams[1] == streams[2]


def test_stream_is_in_order_of_position(shipped):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 3}") for i in range(300)]
    df = shipped.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    first = {r.doc_id: r.position for r in mix.mix_report(df).collect()}
    seen, last = set(), -1.0
    for r in mix.mix_documents(df).collect():
        if r.doc_id not in seen:
            seen.add(r.doc_id)
            assert first[r.doc_id] >= last - 1e-9
            last = first[r.doc_id]
    reported = [r.position for r in mix.mix_report(df).collect() if r.position is not None]
    assert reported == sorted(reported)


def test_schedules_shift_sources_in_time(shipped):
    """The first weight's sources lead, the last weight's close the training."""
    rows = [(i, "a b c", f"s{i % 3}") for i in range(3000)]
    df = shipped.createDataFrame(rows, "doc_id long, text string, source string")
    at = defaultdict(list)
    for r in mix.mix_report(df).collect():
        if r.position is not None:
            at[r.doc_id % 3].append(r.position)
    mean = {k: sum(v) / len(v) for k, v in at.items()}
    assert mean[0] < mean[1] - 0.03


def test_empty_and_clashing(shipped, empty):
    assert mix.mix_report(empty).count() == 0 and mix.mix_documents(empty).count() == 0
    df = shipped.createDataFrame([(1, "a b", "x", 5, "t", 9)], "doc_id long, text string, source string, size int, target string, rank int")
    assert mix.mix_documents(df).columns == df.columns
    assert tuple(mix.mix_report(df).first())[:5] == (1, 2, 2, 2.0, 2)
    blank = shipped.createDataFrame([(1, None, None), (2, " ", None)], "doc_id long, text string, source string")
    assert {tuple(r)[:5] for r in mix.mix_report(blank).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_plan_is_native(tricky):
    plan = mix.mix_report(tricky)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
