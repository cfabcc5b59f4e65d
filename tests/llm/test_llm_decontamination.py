"""Benchmark decontamination against brute force, with hostile rows."""

import hashlib
import random
import re

import pytest

from tidegate.llm import decontamination

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEM_SCHEMA = "item_id long, text string, words string, gram int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, window=10):
    found = []
    grams = [(i, w[k : k + window]) for i, t in items for w in [re.findall(WORD, lowered(t))] for k in range(max(len(w) - window + 1, min(len(w), 1)))]
    for doc_id, text, _ in docs:
        words = re.findall(WORD, lowered(text))
        hit, names = set(), set()
        for item, gram in grams:
            for k in range(len(words) - len(gram) + 1):
                if words[k : k + len(gram)] == gram:
                    hit |= set(range(k, k + len(gram)))
                    names |= {str(item)} - {"None"}
        found.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(map(repr, found))


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(5)
    vocabulary = ["Um", "da", "ÉÉ", "x1", "the", "of", "ñandú"]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, prose(rnd.randint(10, 25))) for i in range(12)] + [(2, "one more of item two"), (100, "short, Item!"), (None, "no id here"), (7, None), (8, "..."), (9, ""), (100, "short, Item!")]
    docs = [(i, prose(rnd.randint(0, 60)), "s") for i in range(40)]
    for i, (item, text) in enumerate(items):
        docs.append((100 + i, f"{prose(9)}; {(text or '').upper()}\n{prose(9)}", "s"))
    docs += [(None, None, None), (None, items[0][1], None), (1, "", None), (1, "", None), (5, "short item", "s"), (5, "short item", "s"), (6, "short item short ITEM", "s"), (7, "--", "s")]
    return docs, items


@pytest.mark.parametrize("set_bytes", [decontamination.SET_BYTES, 0])
def test_contamination_is_brute_force(spark, documents, planted, set_bytes):
    docs, items = planted
    benchmark = spark.createDataFrame([(i, t, "w", 1) for i, t in items], ITEM_SCHEMA)
    got = decontamination.contamination(documents(*docs), benchmark, set_bytes=set_bytes)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(docs, items)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    some = spark.createDataFrame([(1, "a b c", "w", 1)], ITEM_SCHEMA)
    assert decontamination.contamination(documents((1, "a b c", "s")).limit(0), some).count() == 0
    clean = decontamination.contamination(documents((1, "a b c", "s")), none).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in clean] == [(3, 0, 0, False)]
    assert decontamination.decontaminated(documents((1, "a b c", "s")), none, remove="spans").count() == 1


def test_long_text(spark, documents):
    item = " ".join(f"w{i}" for i in range(15))
    text = "of the " * 300_000 + item + " x" * 10 + "z" * 1_000_000
    got = decontamination.contamination(documents((1, text, "s")), spark.createDataFrame([(3, item, "", 0)], ITEM_SCHEMA)).first()
    assert (got.n_words, got.n_hit, got.n_items) == (600_000 + 15 + 10, 15, 1)


def test_spans_and_documents_go(spark, documents, planted):
    docs, items = planted
    benchmark = spark.createDataFrame([(i, t, "w", 1) for i, t in items], ITEM_SCHEMA)
    given = documents(*docs)
    dirty = decontamination.contamination(given, benchmark).filter("contaminated").count()
    kept = decontamination.decontaminated(given, benchmark)
    assert kept.columns == given.columns and kept.count() == len(docs) - dirty
    cut = decontamination.decontaminated(given, benchmark, remove="spans")
    assert cut.columns == given.columns and cut.count() == len(docs)
    one = spark.createDataFrame([(1, "alpha beta gamma", "", 0)], ITEM_SCHEMA)
    texts = ["So: Alpha, BETA gamma! And alpha beta; gamma.", "alpha beta gamma", "  alpha beta gamma alpha beta gamma, é", "alpha beta", None]
    got = decontamination.decontaminated(documents(*((i, t, "s") for i, t in enumerate(texts))), one, remove="spans").orderBy("doc_id")
    assert [r.text for r in got.collect()] == ["So: ! And .", "", "  , é", "alpha beta", None]
