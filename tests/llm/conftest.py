import os
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def shipped(spark):
    from corpusprep.session import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def tricky_rows():
    """Documents with nulls in every column, empty and long texts, copies, near
    copies, repeated rows and odd characters."""
    rng = random.Random(5)
    words = [a + b for a in ("ka", "lo", "mi", "tu", "re", "sho") for b in ("na", "ver", "sted", "tion", "el", "")]
    rows = []
    for i in range(60):
        t = _prose(rng, words, rng.choice([1, 2, 3, 5, 40, 300]))
        rows.append((i, t, rng.choice(["en", "de", "fr", "es"]), f"s{i % 5}", len(t)))
    base = _prose(rng, words, 400)
    for i in range(60, 75):  # near copies: a word or two changed
        w = base.split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "changed"
        t = " ".join(w)
        rows.append((i, t, "en", "hot", len(t)))
    for i in range(75, 90):  # exact copies
        rows.append((i, base, "en", "hot", len(base)))
    long = _prose(rng, words, 30000)
    odd = "tab\there nb sp   line\x0bvt\x0cff \U0001f600 Größe İstanbul KKelvin NUL\x00x \x85nel"
    rows += [
        (90, None, "en", "s1", None), (91, "", "en", "s1", 0), (92, " \n\t ", "de", "s2", 4), (93, "one", "en", None, 3),
        (94, "one two", None, "s1", 7), (95, odd, "fr", None, len(odd)), (96, long, "en", "hot", len(long)), (97, long + " more", "en", "s3", None),
        (98, "日本語 " * 50, None, None, 200), (99, "!!! ### 123 %%%", "es", "s4", 15), (99, "!!! ### 123 %%%", "es", "s4", 15),
        (None, "no id here at all", "en", "s1", 17), (None, base, "en", "s2", len(base)), (None, None, None, None, None),
        (-5, "negative id text", "en", "s0", 16), (1 << 62, "large id text", "en", "s0", 13), (100, base, "en", "s4", len(base)), (100, base, "en", "s4", len(base)),
    ]
    return rows


@pytest.fixture(scope="session")
def tricky(shipped, tricky_rows):
    return shipped.createDataFrame(tricky_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(shipped):
    return shipped.createDataFrame([], SCHEMA)


def pytest_configure(config):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
