"""Toxicity by Levenshtein automata intersected with a lexicon trie.

The lexicon is learned: nodes of the trie of all words whose documents are nearly always labelled toxic. A node
that most of its words end at is a closed term, any other an open stem with free endings. The trie is
intersected with the Levenshtein automaton of each entry, of one error for terms of ``FUZZY_TERM`` and stems of
``FUZZY_STEM`` characters or more; the product is made deterministic state by state when first met, so a word
costs a few table steps. Misspellings that clean documents of the sample hold are words of their own and no hits.

Each hit is judged in its window of words: inside quotation marks beside a reporting word it counts as a
quotation, else as abuse. A logistic model over the counted hits gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.store import stored

#: Rows that the lexicon and the model are fitted on, at most (in expectation; drawn by a hash of the id).
TRAIN_ROWS = 16_000
#: Toxic documents of the sample that an entry is in, at least, and their share if that is more.
SUPPORT, SUPPORT_SHARE = 4, 0.004
#: Places that the draw of the sample can tell apart.
DRAWS = 10**15
FUZZY_TERM, FUZZY_STEM = 5, 8
#: Lengths of the beginnings that can be stems. Whole words are terms at any length.
PREFIXES = range(3, 13)
WINDOW = 8
MEMO = 400_000
#: Words that report speech, and marks that open and close a quotation.
REPORTING = frozenset("said says say wrote writes quoted quote quotes called calls reported reads dijo dit schrieb sagte".split())
OPENING, CLOSING = "\"'“„«‘", "\"'”“»’"
_STRIP = ".,;:!?()[]{}\"'“”„«»‘’*_~-"
FEATURES = ("exact", "fuzzy", "quoted")
#: Where the weights (constant first) are drawn to in the fit, for kinds of hits that the sample lacks.
PRIOR = (-3.0, 4.0, 2.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def plain(word: str) -> str:
    return word.strip(_STRIP).lower()


class Lexicon:
    """Entries (text, closed) and the automaton that matches words against them."""

    def __init__(self, entries: list[tuple[str, bool]], benign: list[str] = ()):
        self.benign = frozenset(benign)
        self._children: list[dict[str, int]] = [{}]
        self._ends: list[tuple[bool, bool] | None] = [None]
        self._reach: list[int] = [0]
        for text, closed in entries:
            at, errors = 0, int(len(text) >= (FUZZY_TERM if closed else FUZZY_STEM))
            self._reach[0] = max(self._reach[0], errors)
            for c in text:
                if c not in self._children[at]:
                    self._children[at][c] = len(self._children)
                    self._children.append({}), self._ends.append(None), self._reach.append(0)
                at = self._children[at][c]
                self._reach[at] = max(self._reach[at], errors)
            self._ends[at] = (closed, bool(errors))
        self._letters = {c for node in self._children for c in node}
        self._ids: dict[frozenset, int] = {}
        self._states: list[frozenset] = []
        self._moves: list[dict[str, int]] = []
        self._start = self._intern({(0, 0)})
        self.memo: dict[str, int] = {}

    def _intern(self, pairs: set[tuple[int, int]]) -> int:
        pairs = set(pairs)
        for node, errors in list(pairs):  # a letter of the entry is left out
            if not errors:
                pairs |= {(child, 1) for child in self._children[node].values() if self._reach[child]}
        state = frozenset((n, e) for n, e in pairs if not (e and (n, 0) in pairs))
        if state not in self._ids:
            self._ids[state] = len(self._states)
            self._states.append(state)
            self._moves.append({})
        return self._ids[state]

    def _accepts(self, at: int, ended: bool) -> int | None:
        """Errors of the best entry that is complete here: an open stem anywhere, a closed term at the end."""
        found = [e for n, e in self._states[at] if (end := self._ends[n]) and e <= end[1] and (ended or not end[0])]
        return min(found) if found else None

    def _compile(self, at: int, char: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, errors in self._states[at]:
            child = self._children[node].get(char)
            if child is not None:
                after.add((child, errors))
            if not errors:  # another letter, or one too many
                after |= {(c, 1) for c in self._children[node].values() if self._reach[c]}
                if self._reach[node]:
                    after.add((node, 1))
        self._moves[at][char] = move = self._intern(after)
        return move

    def match(self, word: str) -> int:
        """0 for no entry, 1 for an exact hit, 2 for a misspelled one."""
        at, best = self._start, None
        for char in plain(word):
            char = char if char in self._letters else ""
            at = self._moves[at].get(char, -1)
            if at < 0:
                at = self._compile(self._last, char)
            self._last = at
            if (stem := self._accepts(at, False)) is not None:
                best = stem if best is None else min(best, stem)
            if not self._states[at]:
                break
        else:
            if (term := self._accepts(at, True)) is not None:
                best = term if best is None else min(best, term)
        return 0 if best is None else best + 1

    def kind(self, word: str) -> int:
        if (known := self.memo.get(word)) is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self._last = self._start
            known = self.match(word)
            known = self.memo[word] = 0 if known == 2 and plain(word) in self.benign else known
        return known

    def features(self, text: str | None) -> tuple[int, int, int]:
        """Hits of each kind in a whole text: exact, misspelled, in quotation."""
        words = (text or "").split()
        exact = fuzzy = quoted = 0
        kinds = list(map(self.kind, words))
        if any(kinds):
            for i, kind in enumerate(kinds):
                if kind and _in_quotation(words, i):
                    quoted += 1
                elif kind == 1:
                    exact += 1
                elif kind == 2:
                    fuzzy += 1
        return exact, fuzzy, quoted


def _in_quotation(words: list[str], i: int) -> bool:
    before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
    opened = max((k for k, w in enumerate(before) if w[0] in OPENING), default=-1)
    closed = max((k for k, w in enumerate(before[:-1]) if w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1] in CLOSING), default=-1)
    if opened <= closed and opened != len(before) - 1 or opened < 0:
        return False
    ends = any(w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1] in CLOSING for w in after)
    return ends and any(plain(w) in REPORTING for w in (*before, *after))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word or a beginning of one; one row per task and term."""
    seen: dict[bool, dict[int, Counter]] = {k: {0: Counter(), 1: Counter()} for k in (False, True)}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {w for w in map(plain, (text or "").split()) if w}
            seen[True][toxic].update(words)
            seen[False][toxic].update({w[:n] for w in words for n in PREFIXES if n <= len(w)})
    for whole, by in seen.items():
        terms = list(by[1])  # a term of clean documents alone is never an entry
        other = [t for t in by[0] if t not in by[1]]
        for part in (terms, other):
            yield pa.RecordBatch.from_pydict(
                {"whole": pa.array([whole] * len(part), pa.bool_()), "term": pa.array(part, pa.string()), "toxic": pa.array([by[1][t] for t in part], pa.int64()), "clean": pa.array([by[0][t] for t in part], pa.int64())}
            )


def learned_lexicon(sample: DataFrame) -> tuple[list[tuple[str, bool]], list[str]]:
    """Entries, and misspellings that are no hits, from rows of ``text`` and ``toxic``.

    The entries are the shortest sure beginnings, each grown while most of it agrees, and the sure words of any length that
    no such beginning covers. Support alone bounds them: each is in ``SUPPORT`` toxic documents of the sample or more. The
    misspellings are words of the sample within one error of a closed term or a stem's beginning.
    """
    counts = sample.mapInArrow(_counted, "whole boolean, term string, toxic long, clean long")
    counts = stored(counts.groupBy("whole", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-terms")
    toxic = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0))).first()[0]
    least = max(SUPPORT, math.ceil(toxic * SUPPORT_SHARE))
    found = counts.filter((F.col("toxic") >= least) & (F.col("clean") <= F.col("toxic") * 0.02)).collect()
    nodes = {r.term: r.toxic for r in found if not r.whole}
    words = {r.term: r.toxic for r in found if r.whole}
    children: dict[str, list[str]] = {}
    for term in sorted(nodes, key=lambda t: (-nodes[t], t)):
        children.setdefault(term[:-1], []).append(term)
    entries = {}
    for term in sorted(nodes, key=len):
        if any(term[:n] in nodes for n in range(1, len(term))):
            continue
        while (longer := children.get(term)) and nodes[longer[0]] >= 0.9 * nodes[term]:
            term = longer[0]
        entries[term] = words.get(term, 0) >= 0.7 * nodes[term]
    stems = {term for term, closed in entries.items() if not closed}
    # Words that no entry covers: short ones, those that part late from a clean word, siblings of a grown beginning.
    entries |= {word: True for word in words if not any(word[:n] in stems for n in PREFIXES)}
    lexicon = sorted(entries.items(), key=lambda e: (-nodes.get(e[0], words.get(e[0], 0)), e[0]))
    misspelt = counts.filter("whole and clean > 0").select("term").mapInArrow(_misspelt(lexicon), "term string")
    return lexicon, [r.term for r in misspelt.collect()]


def _misspelt(lexicon: list[tuple[str, bool]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Lexicon(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"term": pa.array([t for t in batch.column("term").to_pylist() if made.kind(t) == 2], pa.string())})

    return run


def fitted(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic model over log(1 + hits), by Newton steps, drawn to PRIOR."""
    x = np.column_stack([np.ones(len(features)), np.log1p(features)]) if len(features) else np.zeros((0, len(PRIOR)))
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + 0.5 * (w - prior)
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.5 * np.eye(len(w)), slope)
    return w


def _hits(lexicon: list[tuple[str, bool]], benign: list[str], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Lexicon(lexicon, benign)
        for batch in batches:
            counts = [made.features(t.as_py()) for t in batch.column("text")]
            columns = {k: batch.column(k) for k in keep}
            columns |= {f: pa.array([c[i] for c in counts], pa.int64()) for i, f in enumerate(FEATURES)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


class Model:
    def __init__(self, lexicon: list[tuple[str, bool]], benign: list[str], weights: list[float]):
        self.lexicon, self.benign, self.weights = lexicon, benign, weights

    def score(self) -> Column:
        z = F.lit(float(self.weights[0]))
        for f, w in zip(FEATURES, self.weights[1:]):
            z = z + F.lit(float(w)) * F.log1p(f)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn lexicon and weights from labelled documents that are not held out.

    ``labels`` has doc_id and toxic (0 or 1); other values and null ids are ignored. Some ``train_rows``
    labels are drawn by a hash of their id, all of them if there are fewer. Two thirds of them teach the lexicon, the
    others the weights.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, train_rows / max(n, 1))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(DRAWS)) < int(share * DRAWS)) if share < 1 else known
    third = F.pmod(F.xxhash64("doc_id", F.lit("third")), F.lit(3)) == 0
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    sample = stored(sample.select("text", F.col("toxic").cast("int").alias("toxic"), third.alias("third")), "toxic-sample")
    lexicon, benign = learned_lexicon(sample.filter("not third").select("text", "toxic"))
    rest = sample.filter("third").select("text", "toxic")
    hits = rest.mapInArrow(_hits(lexicon, benign, ["toxic"]), "toxic int, " + ", ".join(f"{f} long" for f in FEATURES))
    rows = np.array(hits.groupBy("toxic", *FEATURES).count().collect(), dtype=float).reshape(-1, 5)
    weights = fitted(np.repeat(rows[:, 1:4], rows[:, 4].astype(int), axis=0), np.repeat(rows[:, 0], rows[:, 4].astype(int)))
    return Model(lexicon, benign, weights.tolist())


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted and the hits of each kind for each row of ``docs``, without a shuffle.

    A null text counts as empty; texts without a hit, empty ones too, get the score of no hits. Other columns are
    not looked at. Repeated rows stay repeated, an empty table gives no rows, and a text or word may be of any length.
    """
    given = docs.select("doc_id", "text")
    schema = f"doc_id {dict(given.dtypes)['doc_id']}, " + ", ".join(f"{f} long" for f in FEATURES)
    hits = given.mapInArrow(_hits(model.lexicon, model.benign, ["doc_id"]), schema).withColumn("score", model.score())
    return hits.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *FEATURES)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all columns."""
    columns = docs.columns
    packed = docs.select(F.col("text").alias("text"), F.struct(*[f"`{c}`" for c in columns]).alias("row"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{f} long" for f in FEATURES)
    hits = packed.mapInArrow(_hits(model.lexicon, model.benign, ["row"]), schema)
    return hits.filter(model.score() < threshold).select("row.*")
