import numpy as np
import pytest

from corpusprep.llm import langid

ROWS = "doc_id long, page_id long, declared string, suffix string, domain string, host string, text string"
SAMPLES = {
    "en": "the house of the old king and the green river with many small boats on it",
    "de": "das haus des alten königs und der grüne fluss mit vielen kleinen booten darauf",
    "fr": "la maison du vieux roi et la rivière verte avec beaucoup de petits bateaux",
    "es": "la casa del viejo rey y el río verde con muchos barcos pequeños en él",
}


@pytest.fixture(scope="module")
def model(shipped):
    rows = [(k, v) for k, v in SAMPLES.items() for _ in range(3)] + [(None, "x"), ("xx", "qq"), ("en", None), ("de", "")]
    return langid.train_text_model(shipped.createDataFrame(rows, "lang string, text string"))


def run(spark, model, rows):
    return {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, ROWS).repartition(3), model, ["doc_id"]).collect()}


def test_model_is_a_distribution(model):
    p = np.exp(model[:-1].astype(float)).reshape(-1, 4096, 64).sum(axis=2)
    assert np.allclose(p, 1, atol=1e-3)
    # counted transitions, by hand: after " t" in the English sample
    text = b" " + SAMPLES["en"].encode() + b" "  # texts are read between blanks
    after = [text[i + 2:i + 3] for i in range(len(text) - 2) if text[i:i + 2] == b" t"]
    code = (0 << 12) | (20 << 6) | 8
    want = (3 * after.count(b"h") + langid.ALPHA) / (3 * len(after) + 64 * langid.ALPHA)
    english = model[list(langid.LANGUAGES).index("en")]
    assert np.exp(english[code]) == pytest.approx(want, rel=1e-3)


def test_text_decides_where_it_is_clear(shipped, model):
    rows = [(i, None, None, None, None, None, t[8:]) for i, t in enumerate(SAMPLES.values())]
    got = run(shipped, model, rows)
    assert [got[i].language for i in range(4)] == list(SAMPLES)
    assert all(r.accepted for r in got.values())


def test_evidence_decides_where_text_does_not(shipped, model):
    """A word that is alike in two languages goes with its host, suffix or declaration."""
    rows, n = [], 100
    for lang, text in SAMPLES.items():
        for _ in range(30):
            rows.append((n, None, lang, {"en": "com", "de": "de", "fr": "fr", "es": "es"}[lang], f"{lang}.site", f"www.{lang}.site", text))
            n += 1
    bare = [(i, None, None, None, None, None, "la") for i in (1, 2, 3)]
    for k, (i, *_rest) in enumerate(bare):
        declared, suffix, host = [("es", None, None), (None, "es", None), (None, None, "www.es.site")][k]
        rows.append((i, None, declared, suffix, "es.site" if host else None, host, "la"))
        rows.append((i + 10, None, declared and "fr", suffix and "fr", "fr.site" if host else None, host and "www.fr.site", "la"))
    got = run(shipped, model, rows)
    assert [got[i].language for i in (1, 2, 3)] == ["es"] * 3
    assert [got[i].language for i in (11, 12, 13)] == ["fr"] * 3
    new_host = run(shipped, model, [*rows, (50, None, None, None, "fr.site", "new.fr.site", "la")])
    assert new_host[50].language == "fr"  # an unseen host takes its domain's share


def test_edge_cases(shipped, model, empty):
    rows = [(1, None, None, None, None, None, None), (2, None, "en", "com", "a.b", "a.b", ""), (3, None, None, None, None, None, "123 !!! 456"),
            (4, None, None, None, None, None, "zxqj kqxz wvxq zzkq xjqz " * 20), (5, None, "en", None, None, None, SAMPLES["en"] * 5000),
            (None, None, None, None, None, None, SAMPLES["de"]), (7, None, "fr", "fr", None, "h", SAMPLES["fr"]), (7, None, "fr", "fr", None, "h", SAMPLES["fr"])]
    df = shipped.createDataFrame(rows, ROWS)
    got = [tuple(r)[:2] for r in langid.identify(df, model, ["doc_id"]).collect()]
    assert sorted(got, key=str) == sorted([(1, None), (2, None), (3, None), (4, None), (5, "en"), (None, "de"), (7, "fr"), (7, "fr")], key=str)
    none = shipped.createDataFrame([], ROWS)
    assert langid.identify(none, model, ["doc_id"]).count() == 0
    assert langid.identify_documents(empty).count() == 0 and langid.keep_identified(empty).count() == 0


def test_documents_and_pages_agree_with_their_declarations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = langid.identify_documents(docs, pages).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    html = {r.page_id: r.l for r in pages.selectExpr("page_id", "regexp_extract(html, 'lang=\"([a-z]+)\"', 1) l").collect()}
    assert len(got) == len(lang) + len(html)
    ok = [r.language == (lang[r.doc_id] if r.doc_id is not None else html[r.page_id]) for r in got]
    assert sum(ok) >= 0.98 * len(ok)


def test_held_out_accuracy(spark):
    """Text evidence alone, on documents the model has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train_text_model(docs.where("doc_id % 2 = 0").select("lang", "text"))
    rest = docs.where("doc_id % 2 = 1")
    rows = langid.document_rows(rest, lang_col=None, host_col=None)
    got = {r.doc_id: r.language for r in langid.identify(rows, model, ["doc_id"]).collect()}
    want = {r.doc_id: r.lang for r in rest.select("doc_id", "lang").collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_rejected_documents_go_and_clean_ones_stay(tricky, tricky_rows):
    kept = langid.keep_identified(tricky)
    assert kept.columns == tricky.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert not {90, 91, 92, 99} & set(ids)
    assert set(range(60)) <= set(ids) and ids.count(100) == 2
    texts = [r.text for r in rows if r.doc_id is None]
    assert any(len(t) > 1000 for t in texts) and None not in texts
    by = {r[0]: r[1] for r in tricky_rows if r[0] is not None}
    assert all(r.text == by[r.doc_id] for r in rows if r.doc_id is not None)


def test_a_rejected_text_takes_no_other_text_of_its_id(tricky, tricky_rows, shipped):
    good = [r for r in tricky_rows if r[0] is not None and r[0] < 60 and r[0] >= 0]
    rows = [*good, *((r[0], "!!! 123", *r[2:]) for r in good)]
    kept = langid.keep_identified(shipped.createDataFrame(rows, tricky.schema).repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(r[:2] for r in good)
