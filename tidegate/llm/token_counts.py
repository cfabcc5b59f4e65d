"""Token counts by a compiled finite-state transducer.

A byte-pair encoding is right exactly when each two neighbours are what the merges make of their joined text. So the last
token of each prefix is known from the last tokens of shorter prefixes, and only as far back as a piece can
reach. That is finite state: a state holds the last tokens at the positions that a coming piece may begin at, with the
tokens counted since. Each transition is annotated with the tokens it emits. States are compiled when first met.

No piece runs from other text into a space, so a text falls into words that begin with their spaces; the
transducer starts anew at each. A span of text is therefore a state map of three parts: what comes before its
first space, the count of its whole words, and what follows its last space. Maps of neighbouring spans compose,
in any grouping, so the spans of a text are scanned as a tree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
SPAN = 1 << 16
MEMO = 400_000


class Transducer:
    """Counts the tokens of a sentencepiece model of the byte-pair kind with identity normalisation."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.begins = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece of this model runs over the beginning of a word")
        self._valid: dict[tuple[str, str], bool] = {}
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._moves: list[dict[str, tuple[int, int]]] = []
        self.start = self._intern(("", ((None, 0),)))
        self.memo: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Byte-pair merges of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _neighbours(self, a: str, b: str) -> bool:
        key = (a, b)
        if (known := self._valid.get(key)) is None:
            known = self._valid[key] = self.merged(a + b) == [a, b]
        return known

    def _intern(self, state: tuple) -> int:
        if (known := self._ids.get(state)) is None:
            known = self._ids[state] = len(self._states)
            self._states.append(state)
            self._moves.append({})
        return known

    def _compile(self, at: int, char: str) -> tuple[int, int]:
        """The move from a state by a character: next state and emitted tokens."""
        suffix, ends = self._states[at]
        text = suffix + char
        for length in range(len(text), 0, -1):
            token, (before, counted) = text[-length:], ends[length - 1]
            if (token in self.score or length == 1) and (before is None or self._neighbours(before, token)):
                break
        emitted = counted + (1 if token in self.score else len(char.encode()))
        while text and text not in self.begins:
            text = text[1:]
        kept = ((token, 0), *((t, n - emitted) for t, n in ends))[: len(text) + 1]
        self._moves[at][char] = move = (self._intern((text, kept)), emitted)
        return move

    def run(self, text: str, at: int | None = None) -> tuple[int, int]:
        """State after ``text`` and tokens emitted, from a state, the start by default."""
        at, n, moves = self.start if at is None else at, 0, self._moves
        for char in text:
            at, emitted = moves[at].get(char) or self._compile(at, char)
            n += emitted
        return at, n

    def word(self, word: str) -> int:
        """Tokens of one word with its leading spaces."""
        if (n := self.memo.get(word)) is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            if len(self._states) >= MEMO:  # compiled anew when met again
                self._ids.clear(), self._states.clear(), self._moves.clear(), self._valid.clear()
                self.start = self._intern(("", ((None, 0),)))
            n = self.run(word)[1]
            if len(word) <= 64:
                self.memo[word] = n
        return n

    def span(self, text: str) -> tuple[str, int, str | None]:
        """State map of a span: its first part, tokens of the whole words in between, its last word.

        Whether the first part begins or goes on with a word, the span before tells. Without a beginning of a word
        inside there is no last word.
        """
        head, *words = _words(text)
        return (head, sum(map(self.word, words[:-1])), words[-1]) if words else (head, 0, None)

    def composed(self, a: tuple, b: tuple) -> tuple[str, int, str | None]:
        """State map of two neighbouring spans."""
        (head, n, tail), (next_head, m, last) = a, b
        before = head if tail is None else tail
        if next_head[0] == SPACE != before[-1]:  # a word begins at the border
            n += 0 if tail is None else self.word(tail)
            return (head, n, next_head) if last is None else (head, n + self.word(next_head) + m, last)
        joined = before + next_head
        if tail is None:
            return joined, m, last
        return (head, n, joined) if last is None else (head, n + self.word(joined) + m, last)

    def count(self, text: str | None) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) <= SPAN:
            return sum(map(self.word, _words(text)))
        maps = [self.span(text[i : i + SPAN]) for i in range(0, len(text), SPAN)]
        while len(maps) > 1:
            maps = [self.composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, n, tail = maps[0]
        return self.word(head) + n + (self.word(tail) if tail else 0)


def _words(text: str) -> list[str]:
    """The text cut where spaces follow other text."""
    first, *rest = text.split(SPACE)
    if "" not in rest and (first or len(rest) > 1):
        return [first, *(SPACE + w for w in rest)] if first else [SPACE + w for w in rest]
    return re.findall(f"^[^{SPACE}]+|{SPACE}+[^{SPACE}]*", text)


_COMPILED: dict[str, Transducer] = {}


def compiled(model_file: str) -> Transducer:
    """One transducer for each worker process and model."""
    if model_file not in _COMPILED:
        _COMPILED[model_file] = Transducer(model_file)
    return _COMPILED[model_file]


def token_counts(docs: DataFrame, model_file: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``, without a shuffle.

    A null text counts as empty and has no tokens. ``model_file`` must lie at the same path on each executor.
    Special strings inside texts are ordinary text. Other columns are not looked at.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"doc_id {dict(given.dtypes)['doc_id']}, n_bytes long, n_tokens long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model_file)
        for batch in batches:
            texts = batch.column("text")
            tokens = [transducer.count(t.as_py()) for t in texts]
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return given.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
