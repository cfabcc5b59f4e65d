"""The training-data operators against brute force, with hostile rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import chat_format, components, exact_dedup, hash_search, mixing, segment_sampling, simhash, token_counts, toxicity, url_filter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = "the of and to in is that it was for on as with by at from".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n))


# 1 mixing


def test_mix_targets_and_totals(documents):
    rnd = random.Random(3)
    sources = ["a", "b", "c", "d", None]
    rows = [(i, prose(i, rnd.randint(1, 60)), sources[min(rnd.randint(0, 9), 4)]) for i in range(600)]
    got = mixing.mixed(documents(*rows)).collect()
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(r[1].split())
    weight = dict(zip(sources, itertools.cycle((3, 1, 2))))
    want, open_sources, total = {}, set(sources), 1.5 * sum(size.values())
    while True:
        level = (total - sum(want.values())) / sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if weight[s] * level > 2 * size[s]}
        if not above:
            break
        want |= {s: 2.0 * size[s] for s in above}
        open_sources -= above
    want |= {s: weight[s] * level for s in open_sources}
    assert len(got) == len(rows)
    for s in sources:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["source_size"] == size[s]
        assert mine[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["copies"] * r["size"] for r in mine) - want[s]) <= 60
    assert max(r["copies"] for r in got) <= 2
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(documents(*rows)).collect()))


def test_mix_hostile_rows(documents):
    rows = [(None, None, None), (None, "a b", None), (1, "", "s"), (1, "x y z", "s"), (1, "x y z", "s"), (2, " \x0b\t ", "t")]
    got = mixing.mixed(documents(*rows)).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(
        [(None, None, 0), (None, None, 2), (1, "s", 0), (1, "s", 3), (1, "s", 3), (2, "t", 0)]
    )
    assert mixing.mixed(documents(*rows).limit(0)).count() == 0
    out = mixing.mixed_documents(documents(*rows))
    assert out.columns == documents(*rows).columns
    copies = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in got}
    assert out.filter("text = 'x y z'").count() == 2 * copies[1, "s", 3]


def test_mix_expectation(documents):
    """Each document is taken in the given share of seeds."""
    docs = documents(*[(i, "w " * (i % 5 + 1), "ab"[i % 2]) for i in range(40)])
    taken = Counter()
    for seed in range(12):
        for r in mixing.mixed(docs, weights=(1, 3), share=0.5, most=1.0, seed=seed).collect():
            taken[r["source"]] += r["copies"] * r["size"]
    got = mixing.mixed(docs, weights=(1, 3), share=0.5, most=1.0).select("source", "target").distinct().collect()
    for r in got:
        assert abs(taken[r["source"]] / 12 - r["target"]) <= 2.5


# 2 exact dedup


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for clean, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        left = 1
        for m in members:
            stays = left and (m[0], len(m[1])) == (best[0], len(best[1]))
            left -= bool(stays)
            out.append((m[0], best[0], len(members), bool(stays), hashlib.sha256(clean.encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_against_brute_force(documents):
    long = prose(1, 4000)
    rows = [(1, "a b", "s"), (2, "ab", "s"), (3, " ab\n", "s"), (4, None, "s"), (5, "", None), (None, "\t", "s"), (6, "ab", "s"), (6, "a b c", "s")]
    rows += [(7, long, "s"), (8, long + " ", "s"), (9, long + "x", "s"), (10, long[:-1] + "y", "s"), (11, "Ab", "s"), (12, "é ", "s")]
    rows += [(20, "same row", "s")] * 3 + [(None, "no id", "s")] * 2
    docs = documents(*rows)
    got = exact_dedup.exact_classes(docs)
    assert got.columns == exact_dedup.CLASS_COLUMNS
    assert Counter(tuple(r) for r in got.collect()) == brute_exact(rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for r, n in brute_exact(rows).items() if r[3])
    assert exact_dedup.exact_classes(docs.limit(0)).count() == 0


# 4 url filter


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1", "http://m.example.org/en/12?x#y", "http://xexample.org/en/1",
        "ftp://a.com/fr/2", "http://a.com/de/9#/fr/", "http://a.com/DE/9", "http://com/de/", "http://org", "http://a.net/en/1://b.com/fr/",
        "http://example.org/en/2", "http://a.org?b=/es/", "http://a.com/fr/2", "http://a.com/fr/2",
    ]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r["page_id"]: r for r in url_filter.judged(pages, none).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [r for r in url_filter.LISTED if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0]) + len(r[1]), default=None)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (best and best[0] + best[1])
        assert got[i]["verdict"] == (best[2] if best else "allow")


def test_listed_urls_beside_mined_rules(spark):
    """Rows of listed and other urls, repeated ones, and no pages at all."""
    urls = ["https://a.example.org/es/1", "https://spam.net/x", "https://good.net/y", None, "https://spam.net/x"]
    pages = spark.createDataFrame(list(enumerate(urls * 20)), "page_id long, url string")
    labels = spark.createDataFrame([("https://spam.net/x", True), ("https://good.net/y", False)], "url string, bad boolean")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages, labels, min_support=0.1).collect()}
    assert [got[i] for i in range(100)] == ["block", "block", "allow", "allow", "block"] * 20
    assert url_filter.judged(pages.limit(0), labels).count() == 0


def test_mined_url_rules_against_brute_force(spark):
    rnd = random.Random(5)
    made = [(f"http://{rnd.choice('abc')}.net/{rnd.choice(['x', 'y', 'z'])}/{rnd.randint(1, 999)}",) for _ in range(400)]
    urls = [u for (u,) in made]
    bad = {u: ("a.net/x" in u) or rnd.random() < 0.05 for u in urls}
    labels = spark.createDataFrame(list(bad.items()) + [(None, True), ("http://q.net/", None)], "url string, bad boolean")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages, labels, rules=(), min_support=0.05, min_confidence=0.8).collect()}
    tokens = {r["url"]: set(r["t"]) for r in pages.select("url", url_filter.url_tokens(F.col("url"), *url_filter.host_and_path(F.col("url"))).alias("t")).collect()}
    share = sum(bad.values()) / len(bad)
    sets = {frozenset(c) for t in tokens.values() for n in range(1, 5) for c in itertools.combinations(sorted(t), n)}
    rules = []
    for s in sets:
        holds = [u for u in bad if s <= tokens[u]]
        n_bad = sum(bad[u] for u in holds)
        if n_bad >= 0.05 * len(bad) and n_bad >= 0.8 * len(holds) and n_bad / len(holds) >= 1.2 * share:
            rules.append(s)
    assert rules
    for i, u in enumerate(urls):
        assert got[i] == ("block" if any(s <= tokens[u] for s in rules) else "allow")


def test_mined_rules_of_more_than_four_tokens(spark):
    """Only five tokens together tell the bad urls."""
    urls = {}
    for on in itertools.product((0, 1), repeat=5):
        for i in range(4):
            scheme, sub, word, a, b = (x[o] for x, o in zip((("http", "https"), ("m", "w"), ("x", "y"), ("c", "d"), ("e", "f")), on))
            urls[f"{scheme}://{sub}.a.net/{word}/{i}?{a}=1&{b}=1"] = all(on)
    labels = spark.createDataFrame(list(urls.items()), "url string, bad boolean")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judged(pages, labels, rules=(), min_support=0.02).collect()}
    assert [got[i]["verdict"] for i in range(len(urls))] == ["block" if bad else "allow" for bad in urls.values()]
    assert {r["bad_confidence"] for r in got.values()} == {1.0, None}


# 5 nearest neighbours


def test_nearest_of_two_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8 if i % 5 < 3 else 12).tolist()) for i in range(100)]
    got = hash_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 10, k=3).collect()
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for q in range(10):
        mine = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(set(mine)) == 3 and all(len(units[i]) == len(units[q]) for i in mine)


def test_nearest_recall_and_hostile_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist(), "x") for i in range(1500)]
    rows += [(1500, None, ""), (1550, [0.0] * 16, ""), (1600, [float("nan")] * 16, ""), (1650, [1.0, None] * 8, ""), (1700, [1.0], "")]
    rows += [(None, rows[0][1], ""), (3000, rows[0][1], ""), (3000, rows[0][1], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = hash_search.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    good = [(r[0], np.array(r[1])) for r in rows if r[1] and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    vectors = np.array([g[1] / np.linalg.norm(g[1]) for g in good])
    hits = total = 0
    by_query = defaultdict(list)
    for r in got:
        by_query[r["query_id"]].append(r)
    assert set(by_query) == {g[0] for g in good if g[0] is not None and g[0] % 50 == 0}
    for q, mine in by_query.items():
        if q == 3000:
            continue
        at = next(i for i, g in enumerate(good) if g[0] == q)
        score = vectors @ vectors[at]
        order = sorted((i for i in range(len(good)) if i != at), key=lambda i: (-round(score[i], 12), good[i][0] is None, good[i][0] or 0))[:5]
        mine.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(a["score"] >= b["score"] for a, b in zip(mine, mine[1:]))
        hits += sum((Counter(good[i][0] for i in order) & Counter(r["vec_id"] for r in mine)).values())
        total += 5
    assert hits >= 0.9 * total
    first = sorted(by_query[0], key=lambda r: r["rank"])
    assert [r["vec_id"] for r in first[:3]] == [3000, 3000, None] and first[0]["score"] == pytest.approx(1)


def test_nearest_of_few(spark):
    frame = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = hash_search.nearest(frame, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 0.0), (2, -1.0)]
    assert hash_search.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# 6 simhash


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(points, linked):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(points, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {p: find(p) for p in points}


@pytest.mark.parametrize("leaf", [1000, 8])
def test_simhash_against_brute_force(documents, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rows = [(i, prose(i // 3, 300).replace("of", "OF", i % 3), "s") for i in range(120)]
    rows += [(500 + i, prose(i, 300) + " the" * (i % 4), "s") for i in range(40)]
    rows += [(900, None, "s"), (901, "", "s"), (902, " ", "s"), (903, "One two", "s"), (903, "one two", "s"), (None, "one two", "s")]
    got = simhash.near_classes(documents(*rows)).collect()
    prints = {(r[0], r[1]): brute_fingerprint(r[1]) for r in rows}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for (i, _), f in prints.items():
        least[roots[f]] += [i] if i is not None else []
    want = Counter((r[0], f"{prints[r[0], r[1]]:016x}", min(least[roots[prints[r[0], r[1]]]])) for r in rows)
    assert Counter(tuple(r) for r in got) == want
    kept = simhash.drop_near_copies(documents(*rows, *rows[:5]))
    assert kept.count() == len(set(roots.values()))
    assert simhash.near_classes(documents(*rows).limit(0)).count() == 0


def test_tree_meets_every_near_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 40)
    monkeypatch.setattr(simhash, "HOME_BLOCK", 16)
    monkeypatch.setattr(simhash, "VISIT_BLOCK", 64)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 800, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    points = np.unique(np.concatenate([base, near])).view(np.int64)
    links = simhash.near_links(spark.createDataFrame([(int(p),) for p in points], "fp long"))
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = brute_components([int(p) for p in points], lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    assert {p: got.get(p, p) for p in want} == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 7 chat format


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    alphabet = ["<", "[", "\\", ".", "/", "s>", "INST]", "<<SYS>>", "</s>", "<</ROLE>>", "\n", "é", "$1", ""]
    rows = []
    for conv in range(60):
        for turn in range(rnd.randint(1, 6)):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9)))
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "tool<[\\", "", None]), rnd.choice([text, text, None]), "clash"))
    rows.append((None, None, "user", "x", ""))
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    formatted = chat_format.formatted(frame)
    for r in chat_format.read_back(formatted).collect():
        given = sorted((g for g in rows if g[0] == r["conv_id"]), key=lambda g: (g[1] is not None, g[1]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(g[2] or "", g[3] or "") for g in given]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        for s in r["segments"][1::3]:
            assert not any(c in s["text"] for c in chat_format.INSTRUCT.controls())
        before, valid = "", True
        for g in given:
            valid &= (g[2] or "") in chat_format.INSTRUCT.moves.get(before, ())
            before = g[2] or ""
        assert r["valid"] == (valid and before != "system")
    learned = [s["text"] for r in formatted.collect() for s in r["segments"] if s["loss"]]
    assert len(learned) == sum(g[2] == "assistant" for g in rows)
    assert chat_format.digests(frame.limit(0)).count() == 0


def test_template_must_be_readable():
    with pytest.raises(ValueError):
        chat_format.Template(turns={"user": chat_format.Turn("user:", "</s>")}, moves={})


# 8 token counts


def test_token_counts_as_the_library(documents, spark, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(1)
    alphabet = "ab the▁  \n\tерсñéß{}();\r'\"0123日本🙂zxqw.,-_=<>/s\x00"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", " ", "<s> </s> <unk>", "▁" * 40, "ab" * 5000, prose(1, 9000), " " * 70 + "x"]
    got = token_counts.token_counts(documents(*[(i, t, "s") for i, t in enumerate(texts)]), MODEL, limit=100).collect()
    for r in got:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)
    monkeypatch.setattr(token_counts, "SPAN", 7)
    monkeypatch.setattr(token_counts, "MEMO", 50)
    transducer = token_counts.Transducer(MODEL)
    assert [transducer.count(t) for t in texts] == [len(library.encode(t or "")) for t in texts]


# 9 sampled segmentations


def enumerated(pieces, text):
    text, out = "▁" + text.replace(" ", "▁"), {}

    def rest(i, ids, weight):
        if i == len(text):
            out[tuple(ids)] = weight
            return
        node, alone = np.zeros(1, np.int64), False
        for d in range(min(pieces.longest, len(text) - i)):
            node = pieces.step(node, pieces.char[[ord(text[i + d])]])
            if node[0] < 0:
                break
            if pieces.piece[node[0]] >= 0:
                alone |= d == 0
                rest(i + d + 1, [*ids, int(pieces.piece[node[0]])], weight + pieces.score[node[0]])
        if not alone:
            rest(i + 1, ids + [int(pieces.bytes[b]) for b in text[i].encode()], weight + pieces.bytes_score)

    rest(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: v - total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the", "on of", "é\ner"])
def test_samples_without_replacement(text):
    pieces = segment_sampling.loaded(MODEL)
    odds, n, k = enumerated(pieces, text), 3000, 3
    made = segment_sampling.segmentations(pieces, [text] * n, list(range(n)), k)
    keys = [[tuple(ids.tolist()) for ids, _, _ in samples] for samples in made]
    assert all(len(set(x)) == min(k, len(odds)) for x in keys)
    assert all(abs(p - odds[key]) < 1e-9 for x, s in zip(keys, made) for key, (_, p, _) in zip(x, s))
    first, pair = Counter(x[0] for x in keys), Counter((x[0], x[1]) for x in keys)
    for a, p in odds.items():
        assert abs(first[a] / n - math.exp(p)) < 0.04
        for b, q in odds.items():
            if a != b:
                assert abs(pair[a, b] / n - math.exp(p + q) / -math.expm1(p)) < 0.04
    if len(odds) > k:  # odds over inclusion add up to one on average
        assert np.mean([sum(math.exp(p - i) for _, p, i in s) for s in made]) == pytest.approx(1, abs=0.02)


@pytest.mark.parametrize("block", [65_536, 100])
def test_samples_of_a_long_word(monkeypatch, block):
    """The odds are those of the uncut lattice, and pieces run over any place."""
    monkeypatch.setattr(segment_sampling, "BLOCK", block)
    pieces = segment_sampling.loaded(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "information" * 27 + "日本"
    word = "▁" + text
    plain = [i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
    least = min(s for i in plain if (s := library.get_score(i)) > segment_sampling.NO_RANK)
    score = {library.id_to_piece(i): max(library.get_score(i), least) * segment_sampling.TEMPERATURE for i in plain}
    mass = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        edges = [mass[i] + score[word[i:j]] for i in range(max(0, j - pieces.longest), j) if word[i:j] in score]
        edges += [] if word[j - 1] in score else [mass[j - 1] + pieces.bytes_score]
        mass[j] = np.logaddexp.reduce(edges)
    crossed = set()
    for samples in segmentations_of(pieces, text, 200):
        for ids, log_odds, _ in samples:
            names, at, total = [library.id_to_piece(int(i)) for i in ids], 0, 0.0
            raw = sum(library.is_byte(int(i)) for i in ids)
            for name in names:
                if name in score:
                    crossed |= {c for c in (128, 256) if at < c < at + len(name)}
                    at, total = at + len(name), total + score[name]
            assert raw % 3 == 0
            assert log_odds == pytest.approx(total + raw // 3 * pieces.bytes_score - mass[-1], abs=1e-6)
            assert pieces.decoded(ids) == text
    assert crossed == {128, 256}


def segmentations_of(pieces, text, n):
    return segment_sampling.segmentations(pieces, [text] * n, list(range(n)), 2)


def test_words_are_worked_out_once(monkeypatch):
    """Also for the groups of texts that follow; samples do not depend on what was worked out before."""
    pieces = segment_sampling.Pieces(MODEL)
    texts = [prose(7, 300), "日本🙂 " + "information" * 30, " two  spaces ", ""]
    steps = []
    monkeypatch.setattr(pieces, "step", lambda *given, real=pieces.step: steps.append(1) or real(*given))
    made = segment_sampling.segmentations(pieces, texts, [1, 2, 3, 4], 3)
    assert steps and made
    steps.clear()
    again = segment_sampling.segmentations(pieces, texts[::-1], [4, 3, 2, 1], 3)[::-1]
    assert not steps
    monkeypatch.setattr(segment_sampling, "KEPT_CHARS", 1)
    segment_sampling.segmentations(pieces, [prose(8, 300)], [9], 3)
    anew = segment_sampling.segmentations(pieces, [prose(9, 50), *texts], [9, 1, 2, 3, 4], 3)[1:]
    told = [[[(ids.tolist(), p, i) for ids, p, i in samples] for samples in x] for x in (made, again, anew)]
    assert steps and told[0] == told[1] == told[2]


def test_samples_of_a_number_for_each_row(spark):
    docs = spark.createDataFrame([(1, "the of and", 3), (2, "", 2), (3, "the of", 1)], "doc_id long, text string, n int")
    got = segment_sampling.sampled(docs, MODEL, k=F.col("n"), again=True).collect()
    assert Counter((r["doc_id"], r["sample"]) for r in got) == Counter([(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 1)])
    assert len({tuple(r["ids"]) for r in got if r["doc_id"] == 1}) == 3 and all(r["round_trip"] for r in got)


def test_samples_decode_and_repeat(documents, spark):
    texts = [None, "", " ", "a", "日本🙂\t\n ", "▁▁x", "ab" * 700, prose(2, 400), "  two  spaces ", "\x00\r\n"]
    docs = documents(*[(i, t, "s") for i, t in enumerate(texts)], (None, "no id", "s"), (3, "a", "s"))
    got = segment_sampling.sampled(docs, MODEL, k=3)
    rows = got.collect()
    assert all(r["round_trip"] for r in rows)
    back = segment_sampling.decoded(got, MODEL).collect()
    assert all(r["decoded"] == (texts[r["doc_id"]] or "").replace("▁", " ") for r in back if r["doc_id"] is not None)
    again = segment_sampling.sampled(docs.orderBy(F.desc("doc_id")).coalesce(1), MODEL, k=3).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    assert [tuple(r)[1:5] for r in rows if r["doc_id"] == 1] == [(1, 0, 0.0, 0.0)]
    assert segment_sampling.sampled(docs.limit(0), MODEL, k=3).count() == 0
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(library.decode(r["ids"]) == texts[r["doc_id"]].replace("▁", " ") for r in rows if r["doc_id"] in (3, 5, 6, 7, 8))


# 10 toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    entries = [("idiot", True), ("scum", True), ("vermin", False), ("worthless", True), ("lostraword", False)]
    made, rnd = toxicity.Lexicon(entries), random.Random(7)
    letters = "abcdefghilmnorstuvw1"
    words = [e for e, _ in entries]
    for e, _ in entries:
        for _ in range(300):
            w = list(e)
            for _ in range(rnd.randint(0, 2)):
                at, kind = rnd.randrange(len(w) + 1), rnd.randint(0, 2)
                w[at : at + (kind > 0)] = [] if kind == 2 else [rnd.choice(letters)]
            words.append("".join(w) + rnd.choice(["", "s", "ing"]))
    for w in words:
        best = None
        for e, closed in entries:
            limit = int(len(e) >= (toxicity.FUZZY_TERM if closed else toxicity.FUZZY_STEM))
            d = distance(e, w) if closed else min(distance(e, w[:n]) for n in range(len(w) + 1))
            if d <= limit and (best is None or d < best):
                best = d
        assert made.kind(w) == (0 if best is None else best + 1), w


def test_quotation_is_no_abuse():
    made = toxicity.Lexicon([("idiot", True)])
    assert made.features('He said "you idiot" and left') == (0, 0, 1)
    assert made.features("You idiot! ID1OT, idiots.") == (1, 2, 0)
    assert made.features('"Fine." you idiot') == (1, 0, 0)
    assert made.features(None) == made.features("") == made.features(" \n") == (0, 0, 0)


def test_toxicity_learns_words_that_part_late_and_all_that_have_support(documents, spark):
    """A toxic word equal to a clean one over 16 letters, and more toxic words than any count of entries would hold."""
    rows, marks = [], []
    for i in range(900):
        word = "counterproductivxe" if i % 3 == 0 else "counterproductive"
        rows.append((i, f"{prose(i, 12)} {word} {prose(i + 1, 3)}", "s"))
        marks.append((i, int(i % 3 == 0), 1))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    model = toxicity.fit(documents(*rows), labels)
    assert ("counterproductivxe", True) in model.lexicon
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(documents(*rows), model).collect()}
    assert got == {i: toxic for i, toxic, _ in marks}

    letters = [a + b + c for a in "bcdfgkl" for b in "aeiou" for c in "mnprst"]
    terms = [x + y for x in letters for y in letters[:14]]
    sample = [(" ".join(terms), 1)] * 6 + [("a clean text", 0)] * 6
    lexicon, _ = toxicity.learned_lexicon(spark.createDataFrame(sample, "text string, toxic int"))
    made = toxicity.Lexicon(lexicon)
    assert len(terms) == 2940 and all(made.kind(t) == 1 for t in terms)


def test_toxicity_of_very_long_texts_and_words(documents, spark):
    model = toxicity.Model([("moron", True)], [], list(toxicity.PRIOR))
    rows = [(1, "fine " * 400_000 + "you moron", "s"), (2, "x" * 2_000_000, "s"), (2, "x" * 2_000_000, "s"), (3, "moron" * 100_000, "s")]
    got = sorted((r["doc_id"], r["exact"], r["predicted"]) for r in toxicity.scored(documents(*rows), model, threshold=0.4).collect())
    assert got == [(1, 1, 1), (2, 0, 0), (2, 0, 0), (3, 0, 0)]


def test_toxicity_learns_from_its_rows_alone(documents, spark):
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(i, 30).split()
        if toxic:
            words[3], words[9] = ("moron", "trash")[i % 8 == 0], "scum"
        rows.append((i, " ".join(words), "s"))
        marks.append((i, int(toxic), 1))
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "you moron scum", "s"), (1002, "you mor0n, tr4sh", "s"), (5, prose(5, 30), "s")]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (7, None, 1), (8, 5, 0)], "doc_id long, toxic int, quality int")
    docs = documents(*rows)
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(rows)
    toxic = {i for i, t, _ in marks if t}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is not None and r["doc_id"] < 1000:
            assert r["predicted"] == int(r["doc_id"] in toxic)
            assert r["held_out"] == (__import__("zlib").crc32(str(r["doc_id"]).encode()) % 3 == 1)
    flipped = spark.createDataFrame([(i, 1 - t if __import__("zlib").crc32(str(i).encode()) % 3 == 1 else t, 1) for i, t, _ in marks], labels.schema)
    assert toxicity.fit(docs, flipped).lexicon == model.lexicon
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1000, 1001} and kept.filter("doc_id is null").count() == 0
    empty = toxicity.fit(docs, labels.limit(0))
    assert toxicity.scored(docs, empty).filter("predicted = 1").count() == 0
    assert toxicity.scored(docs.limit(0), model).count() == 0


# 3 passages


def test_windows_do_not_travel_with_pairs(documents, monkeypatch):
    """Texts that repeat a line meet once, however often they have it, and the passage between the lines is found."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(8)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    line, passage, kept = words(40), words(60), {}
    rows = [sum((line + words(25) for _ in range(60)), []) + (passage + words(30) if i % 3 == 0 else []) for i in range(9)]
    monkeypatch.setattr(passage_dedup, "stored", lambda frame, name, real=passage_dedup.stored: kept.setdefault(name, real(frame, name)))
    got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*[(i, " ".join(r), "s") for i, r in enumerate(rows)])).collect()}
    assert kept["passage-pairs"].columns == ["a", "b"] and kept["passage-pairs"].count() <= 36
    assert all(any(p["start"] <= 3900 and p["end"] >= 3960 for p in got[i]["passages"]) for i in (0, 3, 6))
    members = kept["passage-members"]
    assert members.groupBy("key", "side", "flank", "cls").count().filter("count > 1").count() == 0


def test_texts_do_not_travel_with_pairs(documents, monkeypatch):
    """Each two of 40 texts are compared, those of different places too, and each text goes once to a place."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(9)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    line, rows = words(26), []
    for _ in range(20):
        left, right = words(17), words(17)
        rows += [words(30) + left + line + right + words(30), words(30) + left[:15] + words(1) + left[16:] + line + right + words(30)]
    for chars in (passage_dedup.PLACE_CHARS, 4_000):
        kept = {}
        with monkeypatch.context() as m:
            m.setattr(passage_dedup, "PLACE_CHARS", chars)
            m.setattr(passage_dedup, "stored", lambda frame, name, real=passage_dedup.stored, kept=kept: kept.update({name: real(frame, name)}) or kept[name])
            got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*[(i, " ".join(r), "s") for i, r in enumerate(rows)])).collect()}
        assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == {i: (i - i % 2, 1) for i in range(40)}
        pairs, sent = kept["passage-pairs"].count(), kept["passage-placed"]
        assert pairs > 700 and sent.count() == sent.distinct().count() and sent.count() < (pairs if chars == 4_000 else pairs / 2)
        assert (kept["passage-places"].select("x", "y").distinct().count() > 1) == (chars == 4_000)


def test_runs_of_a_word_are_told_apart_early():
    """A word said 40 times in two texts is no passage; said 60 times it is one. Only then are windows looked through."""
    from tidegate.llm import passage_dedup

    def texts(n):
        return [" ".join([f"{of}{i}" for i in range(70)] + ["the"] * n + [f"{of}{i}" for i in range(70, 140)]).encode() for of in "ab"]

    (one, two), (three, four) = passage_dedup._texts(texts(40)), passage_dedup._texts(texts(60))
    hit = passage_dedup._among(one.shingles, two.sorted)
    assert hit.sum() == 36 and not one.similar(0, hit) and passage_dedup._passages(one, two) == []
    assert three.similar(0, passage_dedup._among(three.shingles, four.sorted))
    assert any(p[0] <= 70 and p[1] >= 130 and p[2] <= 70 and p[3] >= 130 for p in passage_dedup._passages(three, four))


def test_texts_worked_on_together_are_as_alone():
    from tidegate.llm import passage_dedup

    line = prose(1, 30)
    bodies = [" ".join([prose(i, 60), line, "the " * 70 * (i % 2), line, prose(i + 9, 60)]).encode() for i in range(6)]
    for body, together in zip(bodies, passage_dedup._texts(bodies)):
        (alone,) = passage_dedup._texts([body])
        assert together.shingles.tolist() == alone.shingles.tolist() and len(alone.grouped[0])
        assert all(x.tolist() == y.tolist() for x, y in zip(together.grouped, alone.grouped))


def test_windows_of_pairs_without_a_passage_are_not_worked_out(monkeypatch):
    """Each two of 40 texts that share a line, and two of them alone a passage around it: windows are taken of these two."""
    import pyarrow as pa

    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(11)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    line, left, right, seen = words(26), words(17), words(17), []
    texts = [" ".join(words(47) + line + words(47)) for _ in range(38)]
    texts += [" ".join(words(30) + left + line + right + words(30)), " ".join(words(30) + left[:15] + words(1) + left[16:] + line + right + words(30))]
    rows = [(i, None, text) for i, text in enumerate(texts)] + [(i, j, None) for j in range(40) for i in range(j)]
    place = [pa.array([0] * len(rows))] * 3
    columns = [*place, *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))]
    batch = pa.RecordBatch.from_arrays(columns, ["block", "x", "y", "a", "b", "text"])
    monkeypatch.setattr(passage_dedup, "_compact", lambda values, *of, real=passage_dedup._compact: seen.append(len(values)) or real(values, *of))
    batches = [batch.slice(i, 100) for i in range(0, len(rows), 100)]
    found = [tuple(r.values()) for got in passage_dedup._verified(iter(batches)) for r in got.to_pylist()]
    assert {f[:2] for f in found} == {(38, 39)} and any(f[2] <= 30 and f[3] >= 90 for f in found)
    assert len(seen) == passage_dedup.FUNCTIONS and max(seen) <= 2 * 120


def test_pairs_told_many_at_once_are_as_one_by_one():
    """Texts of few words, runs and lines: no pair with a passage is left out, and others as ``similar`` has it."""
    from tidegate.llm import passage_dedup

    rnd = random.Random(7)
    parts = [prose(i, 30).split() for i in range(8)] + [["the"] * 45, ["a", "b"] * 20]
    bodies = [" ".join(sum(rnd.choices(parts, k=4), []) + prose(100 + i, rnd.randrange(20, 90)).split()).encode() for i in range(40)]
    texts = passage_dedup._texts(bodies)
    lot = passage_dedup._Lot(texts)
    x, y = (np.array(of) for of in zip(*((i, j) for i in range(40) for j in range(40) if i != j)))
    got = lot.similar(x, y)
    assert 0 < got.sum() < len(got)
    for i, j, told in zip(x.tolist(), y.tolist(), got.tolist()):
        hit = passage_dedup._among(texts[i].shingles, texts[j].sorted)
        assert told == texts[i].similar(0, hit) or np.count_nonzero(hit) >= passage_dedup.SIMILARITY * len(hit)
        assert told or not passage_dedup._passages(texts[i], texts[j])


def test_word_hashes_tell_words_apart():
    """As bytes.split() has them, with A-Z lower-cased; words that are equal but for a zero byte, their length or a late byte differ."""
    from tidegate.llm import passage_dedup

    rnd, seen = random.Random(4), {}
    letters = [b"a", b"A", b"b", b"\0", b" ", b"\t", b"\x0b", b"\x0c", b"\r", b"\n", b"\x1c", b"\x85", "\u00e4".encode()]
    texts = [b"", b" ", b"a", b"\0", b"\0\0 a\0"] + [b"".join(rnd.choices(letters, k=rnd.randrange(60))) for _ in range(500)]
    texts += [b" ".join(b"ab"[i % 2 :][:1] * n + b"x" * (i // 2) for i in range(4)) for n in range(140)]
    for text in texts:
        words = text.translate(bytes.maketrans(b"AB", b"ab")).split()
        hashes = passage_dedup.word_hashes(text).tolist()
        assert len(hashes) == len(words)
        seen.update(zip(words, hashes))
        assert [seen[w] for w in words] == hashes
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_of_any_length():
    """Those of the library, worked out together."""
    import xxhash

    from tidegate.llm import passage_dedup

    words = [bytes(random.Random(n).choices(b"abc\0\xff\x85", k=n)) for n in [*range(1, 80), 200]]
    assert passage_dedup.word_hashes(b" ".join(words)).tolist() == [xxhash.xxh64_intdigest(w) for w in words]


@pytest.mark.parametrize("n", [0, 19, 20, 21, 90])
def test_compact_windows_against_brute_force(n):
    from tidegate.llm import passage_dedup

    values = np.array([random.Random(n * 1000 + i).randrange(40) for i in range(n)], np.uint64)
    want = set()
    for i in range(n):
        for j in range(i + 19, n):
            left = right = centre = i + int(values[i : j + 1].argmin())
            while left and values[left - 1] > values[centre]:
                left -= 1
            while right + 1 < n and values[right + 1] >= values[centre]:
                right += 1
            want.add((left, centre, right))
    assert set(passage_dedup.compact_windows(values, 20)) == want


def test_repeated_passages(documents):
    from tidegate.llm import passage_dedup

    shared = prose(900, 60)
    rows = [(i, prose(i, 80) + " " + shared + " " + prose(i + 50, 40), "s") for i in range(3)]
    rows += [(10, prose(10, 200), "s"), (11, None, "s"), (12, "", "s"), (13, "short text", "s"), (14, "short text", "s")]
    rows += [(20, prose(20, 70), "s"), (21, prose(20, 70), "s"), (None, prose(30, 70), "s")]
    got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*rows)).collect()}
    assert set(got) == {0, 1, 2, 20, 21}
    assert {got[i]["class_id"] for i in (0, 1, 2)} == {0} and {got[i]["class_id"] for i in (20, 21)} == {20}
    assert all(any(p["start"] <= 84 and p["end"] >= 136 for p in got[i]["passages"]) for i in (0, 1, 2))
    assert passage_dedup.repeated_passages(documents(*rows).limit(0)).count() == 0


def test_a_passage_that_no_representative_has(documents):
    """All rows share a short line; only the two in the middle share the passage of exactly 50 words behind it."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(3)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    line, passage = words(20), words(30)
    rows = [(i, " ".join(words(30) + line + (passage if i % 10 == 4 else words(30)) + words(30)), "s") for i in range(40)]
    got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*rows)).collect()}
    assert set(got) == {4, 14, 24, 34}
    assert {r["class_id"] for r in got.values()} == {4}
    assert all(any(p["start"] <= 30 and p["end"] >= 75 for p in r["passages"]) for r in got.values())


def test_all_passages_of_a_pair(documents):
    """Two passages with other words between them, one of them twice in a text, and one that marks alone tie."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(4)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    p, q, long, line = words(60), words(60), words(120), words(20)
    rows = [(1, p + words(100) + q, "s"), (2, q + words(100) + p + words(100) + p, "s"), (3, p + q, "s")]
    rows += [(10 + i, words(30) + line + (long if i % 10 == 4 else words(30)) + words(30), "s") for i in range(40)]
    got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*[(i, " ".join(w), s) for i, w, s in rows])).collect()}
    assert set(got) == {1, 2, 3, 14, 24, 34, 44}
    want = {1: [(0, 60), (160, 220)], 2: [(0, 60), (160, 220), (320, 380)], 3: [(0, 60), (60, 120)]} | {i: [(50, 170)] for i in (14, 24, 34, 44)}
    for i, spans in want.items():
        assert all(any(p["start"] <= a and p["end"] >= b for p in got[i]["passages"]) for a, b in spans)


def test_marks_of_a_pair_are_merged(spark):
    from tidegate.llm import passage_dedup

    marks = {cls: [(c, [1000 + c - shift - passage_dedup.STEP * i for i in range(len(passage_dedup.MARKS))]) for c in (shift + 50, shift + 70)] for cls, shift in ((1, 0), (2, 7))}
    rows = [(cls, 400, c, m) for cls, of in marks.items() for c, m in of]
    links = passage_dedup._marked_links(spark.createDataFrame(rows, "cls long, n int, c int, marks array<long>")).collect()
    assert [tuple(r) for r in links] == [(1, 2, 8, 115, 15, 122)]


def test_similar_passages_around_a_hot_line(documents):
    """All rows share a line; each two alone share a passage of 60 words around it, edited, with no 45 equal words."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(5)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    line, rows = words(26), []
    for _ in range(80):
        left, right = words(17), words(17)
        rows += [words(30) + left + line + right + words(30), words(30) + left[:15] + words(1) + left[16:] + line + right + words(30)]
    got = {r["doc_id"]: r for r in passage_dedup.repeated_passages(documents(*[(i, " ".join(r), "s") for i, r in enumerate(rows)])).collect()}
    assert all(r["class_id"] == i - i % 2 and r["n_links"] == 1 for i, r in got.items())
    assert all(any(p["start"] <= 30 and p["end"] >= 90 for p in r["passages"]) for r in got.values())
    assert len(got) == 160


def test_all_links_are_counted(documents):
    """A passage in 40 texts and one in 5 of them, a line that alone ties nobody, and texts of one edit each, near enough if they have them side by side."""
    from tidegate.llm import passage_dedup

    rng = np.random.default_rng(6)
    words = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    hot, few, line = words(70), words(60), words(20)
    rows = [words(20) + hot + words(20) + (few if i < 5 else []) + words(20) for i in range(40)]
    rows += [words(30) + few + words(20) for _ in range(3)]
    rows += [words(30) + line + words(60) for _ in range(10)]
    body = words(60)
    rows += [words(30) + [w if j != 30 + i else "edited" for j, w in enumerate(body)] + words(30) for i in range(6)]
    got = {r["doc_id"]: r["n_links"] for r in passage_dedup.repeated_passages(documents(*[(i, " ".join(r), "s") for i, r in enumerate(rows)])).collect()}
    assert got == {i: 42 if i < 5 else 39 for i in range(40)} | {i: 7 for i in (40, 41, 42)} | {53: 1, 54: 2, 55: 2, 56: 2, 57: 2, 58: 1}
