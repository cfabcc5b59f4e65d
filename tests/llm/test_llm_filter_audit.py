"""The audit of filters against brute force over all orders, with hostile rows."""

import itertools
import random
import re

from tidegate.llm import filter_audit

LABEL_SCHEMA = "doc_id long, quality int, toxic int, source string, mask int"
WORD = r"[^\x20\x09-\x0D]+"


def fails(docs, at):
    doc_id, text, _ = docs[at]
    text = text or ""
    words = re.findall(WORD, text)
    smaller = [d for d in docs if (d[1] or "") == text and d[0] is not None and (doc_id is None or d[0] < doc_id)]
    return "".join(
        letter
        for letter, bad in zip(
            "ABCDE", [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), bool(smaller)]
        )
        if bad
    )


def brute(docs, labels):
    failed = [fails(docs, i) for i in range(len(docs))]
    mark = lambda i, k: any(row[0] == docs[i][0] is not None and row[k] == 1 for row in labels)
    out, shapley = {}, {}
    for part in {d[2] or "" for d in docs}:
        mine = [i for i, d in enumerate(docs) if (d[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [i for i in left if letter in failed[i]]
                redundant = [i for i in mine if i not in left and letter in failed[i]]
                left = [i for i in left if letter not in failed[i]]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
                out[part, order, step] = [len(left), len(gone), len(redundant), sum(failed[i] == letter for i in mine), sum(mark(i, 1) for i in gone), sum(mark(i, 2) for i in gone)]
    return sorted((*key, *values, shapley[key[0], key[1][key[2] - 1]]) for key, values in out.items())


def planted():
    rnd = random.Random(9)
    words = ["the", "of", "Up", "CAPS", "a#b", "né", "漢字", "x"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(words[k:]) for _ in range(rnd.choice((0, 3, 49, 50, 51, 120)))) for k in (0, 5, 8) for _ in range(12)]
    texts += ["\x0b \t", "", None, "a" * 300, "a" * 300 + "b", "a" * 299, "né\x85x", "A"]
    docs = [(rnd.choice((None, rnd.randint(0, 40))), rnd.choice(texts), rnd.choice(("s", "t", None))) for _ in range(160)]
    labels = [(i, rnd.choice((0, 1, None)), rnd.choice((0, 1)), "z", 1) for i in range(30)] + [(None, 1, 1, "z", 1), (3, 1, 1, "z", 1), (3, 0, 0, "z", 1)]
    return docs + docs[:20], labels


def test_audit_is_brute_force(spark, documents, monkeypatch):
    docs, labels = planted()
    given, marks = documents(*docs).repartition(3), spark.createDataFrame(labels, LABEL_SCHEMA)
    want = brute(docs, labels)
    assert sorted(map(tuple, filter_audit.audit(given, marks).collect())) == want
    for name, value in (("TRIE_BYTES", 500), ("FIRST_PREFIX", 1), ("LONGER", 2), ("ALIKE_BYTES", 100)):
        monkeypatch.setattr(filter_audit, name, value)
    assert sorted(map(tuple, filter_audit.audit(given, marks).collect())) == want


def test_empty_tables(spark, documents):
    none, marks = documents((1, "a", "s")).limit(0), spark.createDataFrame([], LABEL_SCHEMA)
    assert filter_audit.audit(none, marks).count() == 0
    assert filter_audit.audit(documents((1, "a", "s")), marks).count() == 600


def test_long_texts_with_a_common_beginning(spark, documents):
    body = "lorem ipsum " * 100_000
    docs = [(3, body + "x", "s"), (2, body + "x", "s"), (1, body, "s"), (9, body + "y", "s"), (2, body + "x", "s")]
    got = filter_audit.masks(documents(*docs).repartition(5)).groupBy("doc_id").agg({"mask": "max", "n": "sum"}).orderBy("doc_id").collect()
    assert [tuple(r)[1:] in ((2, n), (n, 2), (18, n), (n, 18)) for r, n in zip(got, (1, 2, 1, 1))] == [True] * 4
    assert {r.doc_id: bool(max(r.asDict()["max(mask)"], 0) & filter_audit.DUPLICATE) for r in got} == {1: False, 2: False, 3: True, 9: False}


def test_trie_of_hostile_texts():
    rnd = random.Random(1)
    rows = [(rnd.choice((None, 1, 2, 3, 4)), bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(0, 6)))) for _ in range(500)]
    trie = filter_audit.Trie()
    for at, (doc_id, text) in enumerate(rows):
        trie.insert(text, doc_id, at)
    got = {at: (copy, text) for _, at, copy, text in trie.flagged()}
    ids = lambda text: [i for i, t in rows if t == text and i is not None]
    assert got == {at: (any(doc_id is None or i < doc_id for i in ids(text)), text) for at, (doc_id, text) in enumerate(rows)}
