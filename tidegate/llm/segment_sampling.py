"""Sampled sentencepiece segmentations without replacement, by perturbed A* search.

A text's lattice has a node before each character and an edge for each piece; a segmentation is a path, with
odds exp(sum of the scores of its pieces * ``TEMPERATURE``). Every set of paths has a known mass, so its best path under
Gumbel noise can be drawn without looking inside: a queue holds disjoint sets, each with the perturbed score of its
best path as exact bound. The set with the best bound is opened: a path is drawn from it, and what is left of
it returns to the queue in parts, truncated at that bound. The paths come out in the order of their perturbed
scores, which is a sample without replacement; the score after the last one gives their odds of inclusion.

No piece runs over the beginning of a word, so the lattice of a text is a chain of lattices of words, and each
distinct word is worked out once for many texts. Words longer than ``WORD_CHARS`` are worked out in blocks of
places, with edges over the borders. Noise is a hash of the row's key and the place, so a row has the same samples
in any batch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.token_counts import SPACE, _words

TEMPERATURE = 2e-4
WORD_CHARS = 128
#: Places of a longer word whose edges are looked up at once.
BLOCK = 65_536
#: Characters of the words whose lattices stay for the next texts, some; an edge takes 17 bytes.
KEPT_CHARS = 1_000_000
#: Scores from here down mark pieces without a rank of their own, as runs of spaces; they count as the least rank.
NO_RANK = -1e8
#: Characters of the texts that share one table of word lattices, and ids that go out at once, some. A sample of a text takes
#: a sixteenth of its lattices' memory or less, and counts as that.
BATCH_CHARS, OUT_IDS = 500_000, 500_000
#: Score of a character that is no piece and goes out as bytes, below the least piece.
BYTES_SCORE = -10.0
_BYTES = -2


class Pieces:
    """The model as a trie in arrays, and its ids both ways."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        text = [b"" if model.is_control(i) or model.is_unknown(i) else bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        self.text = pa.array(text, pa.large_binary())
        self._lattices: Lattices | None = None
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        chars = sorted({c for i in plain for c in model.id_to_piece(i)})
        self.char = np.zeros(0x110000, np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.n_chars = len(chars) + 1
        moves: dict[tuple[int, int], int] = {}
        piece, score = [-1], [-np.inf]
        least = min(model.get_score(i) for i in plain if model.get_score(i) > NO_RANK)
        for i in plain:
            node = 0
            for c in model.id_to_piece(i):
                key = (node, int(self.char[ord(c)]))
                if key not in moves:
                    moves[key] = len(piece)
                    piece.append(-1), score.append(-np.inf)
                node = moves[key]
            piece[node], score[node] = i, max(model.get_score(i), least) * TEMPERATURE
        self.longest = max(len(model.id_to_piece(i)) for i in plain)
        keys = np.array([a * self.n_chars + b for a, b in moves], np.int64)
        self.shift = np.uint64(64 - (4 * len(keys)).bit_length())
        self.keys = np.full(1 << (4 * len(keys)).bit_length(), -1, np.int64)  # a hash table; a key lies in its slot or one behind it
        self.next = np.full(len(self.keys), -1, np.int64)
        left, to, slot = keys, np.array(list(moves.values()), np.int64), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = left[free]
            there = self.keys[slot] == left
            self.next[slot[there]] = to[there]
            left, to, slot = left[~there], to[~there], (slot[~there] + 1) % len(self.keys)
        self.piece, self.score = np.array(piece, np.int32), np.array(score)
        self.begin = self.step(np.zeros(self.n_chars, np.int64), np.arange(self.n_chars))
        self.bytes_score = least * TEMPERATURE + BYTES_SCORE

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Nodes behind the given ones, -1 for none."""
        key = node * self.n_chars + char
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.next[slot], -1)
        on = np.nonzero((held != key) & (held != -1))[0]
        while len(on):
            slot[on] = (slot[on] + 1) % len(self.keys)
            held = self.keys[slot[on]]
            hit = held == key[on]
            out[on[hit]] = self.next[slot[on[hit]]]
            on = on[~hit & (held != -1)]
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def decoded(self, ids: np.ndarray) -> str:
        """The text of a whole segmentation; spaces come back for their marks."""
        return self.written(ids)[1:].decode(errors="replace")

    def written(self, ids: np.ndarray) -> bytes:
        """The bytes of all pieces in a row, with the space that a text begins with."""
        if not len(ids):
            return b""
        taken = self.text.take(pa.array(ids))
        low, high = taken.offset, taken.offset + len(taken)
        ends = np.frombuffer(taken.buffers()[1], np.int64)
        return taken.buffers()[2][int(ends[low]) : int(ends[high])].to_pybytes()

    def lattices(self) -> Lattices:
        """The lattices of the words met so far, or new ones where these are ``KEPT_CHARS`` or more."""
        if self._lattices is None or self._lattices.rows >= KEPT_CHARS:
            self._lattices = Lattices(self)
        return self._lattices


class Lattices:
    """Word lattices, the edges of each node side by side; words that were met stay, so that later texts find them."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.index = _Index()
        self.rows = self.edges = 0
        self.length, self.base = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of each word
        self.first, self.char = np.zeros(1, np.int64), np.zeros(0, np.uint32)  # of each node
        # Of each edge; ``cum`` are the odds up to an edge in parts of 2 ** 32, the whole for the last one of a node.
        self.cum, self.logp = np.zeros(0, np.uint32), np.zeros(0)
        self.piece, self.size = np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def numbers(self, text: str) -> np.ndarray:
        """The number of each word of a text; new ones await ``fill``."""
        keys = text.replace(SPACE, " ").split(" ") if text else []
        if "" in keys:
            keys = [w[1:] for w in _words(SPACE + text.replace(" ", SPACE))]
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def fill(self) -> None:
        """Work out the words that are new."""
        words, self.index.new = [SPACE + w for w in self.index.new], []
        if not words:
            return
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.length = np.concatenate([self.length, length])
        self.base = np.concatenate([self.base, self.rows + np.cumsum(length) - length])
        start = 0
        for i in [*np.nonzero(length > WORD_CHARS)[0].tolist(), len(words)]:
            if start < i:
                self._fill("".join(words[start:i]), length[start:i])
            if i < len(words):
                self._fill_long(np.frombuffer(words[i].encode("utf-32-le"), np.uint32))
            start = i + 1

    def row(self, edge: np.ndarray) -> np.ndarray:
        """The nodes of these edges."""
        return np.searchsorted(self.first[: self.rows + 1], edge, side="right") - 1

    def draw(self, row: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node that a number of 32 bits picks."""
        u = np.minimum(u, np.uint64(0xFFFFFFFE)).astype(np.uint32)
        edge = self.first[row]
        on = np.nonzero(self.cum[edge] <= u)[0]
        at, left = edge[on], u[on]
        while len(on):
            at += 1
            edge[on] = at
            more = self.cum[at] <= left
            on, at, left = on[more], at[more], left[more]
        return edge

    def _found(self, code: np.ndarray, left: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """(node, size, piece, score) of the edges of the first ``n`` nodes, by node and size; ``left`` are the characters to a word's end."""
        pieces, char = self.pieces, self.pieces.char[code]
        alive, node, found = np.arange(n), np.zeros(n, np.int64), []
        for d in range(pieces.longest):
            there = left[alive] > d
            alive, node = alive[there], node[there]
            node = pieces.step(node, char[alive + d]) if d else pieces.begin[char[:n]]
            ends = (node >= 0) & (pieces.piece[node] >= 0)
            if d:
                found.append((alive[ends], pieces.piece[node[ends]], pieces.score[node[ends]]))
            else:  # a character that is no piece goes out as bytes
                found.append((alive, np.where(ends, pieces.piece[node], _BYTES), np.where(ends, pieces.score[node], pieces.bytes_score)))
            alive, node = alive[node >= 0], node[node >= 0]
            if not len(alive):
                break
        size = np.repeat(np.arange(1, len(found) + 1), [len(f[0]) for f in found])
        row, piece, score = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.argsort(row, kind="stable")
        return row[order], size[order], piece[order], score[order]

    def _add(self, code: np.ndarray, row: np.ndarray, size: np.ndarray, piece: np.ndarray, logp: np.ndarray) -> None:
        """Append nodes with their edges, whose odds add up to one for each node."""
        count = np.bincount(row, minlength=len(code))
        first = np.cumsum(count) - count
        odds, cum = np.exp(logp), np.empty(len(logp), np.uint32)
        total, at = np.zeros(len(code)), np.arange(len(code))
        for k in range(int(count.max())):  # node by node, so that the place in the tables does not matter
            at = at[count[at] > k]
            total[at] += odds[first[at] + k]
            cum[first[at] + k] = np.minimum(total[at] * 2.0**32, 0xFFFFFFFF)
        cum[first + count - 1] = 0xFFFFFFFF
        for name, n, values in (("first", self.rows + 1, self.edges + first + count), ("char", self.rows, code)):
            setattr(self, name, _appended(getattr(self, name), n, values))
        for name, values in (("cum", cum), ("logp", logp), ("piece", piece), ("size", size)):
            setattr(self, name, _appended(getattr(self, name), self.edges, values))
        self.rows, self.edges = self.rows + len(code), self.edges + len(logp)

    def _fill(self, text: str, length: np.ndarray) -> None:
        """Words of these lengths, whose characters follow each other in ``text``."""
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(code)
        left = np.repeat(np.cumsum(length), length) - np.arange(n)
        row, size, piece, score = self._found(code, left, n)
        ahead = np.zeros(n + 1)  # the mass behind each node, the last one for all ends of words
        to = np.where(size == left[row], n, row + size)
        order = np.argsort(left[row].astype(np.uint8), kind="stable")  # from the ends of the words on
        new = np.diff(row[order], prepend=-1) != 0
        begins, rows = np.nonzero(new)[0], row[order][new]
        by_to, by_score, count = to[order], score[order], np.diff(begins, append=len(order))
        nodes = np.concatenate([[0], np.cumsum(np.bincount(left[rows]))])
        for a, b in zip(nodes[:-1].tolist(), nodes[1:].tolist()):
            if a == b:
                continue
            low, high = begins[a], begins[b] if b < len(begins) else len(order)
            weight = by_score[low:high] + ahead[by_to[low:high]]
            top = np.maximum.reduceat(weight, begins[a:b] - low)
            odds = np.exp(weight - np.repeat(top, count[a:b]))
            ahead[rows[a:b]] = top + np.log(np.add.reduceat(odds, begins[a:b] - low))
        self._add(code, row, size, piece, score + ahead[to] - ahead[row])

    def _fill_long(self, code: np.ndarray) -> None:
        """As ``_fill`` for one word, in blocks from its end; the masses behind a block are carried over its border."""
        n, most = len(code), self.pieces.longest
        ahead, blocks = np.full(n + most, -np.inf), []
        ahead[n] = 0.0
        for low in range((n - 1) // BLOCK * BLOCK, -1, -BLOCK):
            high = min(low + BLOCK, n)
            row, size, piece, score = self._found(code[low : high + most], n - np.arange(low, high), high - low)
            begins, to = np.searchsorted(row, np.arange(high - low + 1)).tolist(), row + size + low
            for i in range(high - low - 1, -1, -1):
                a, b = begins[i], begins[i + 1]
                weight = score[a:b] + ahead[to[a:b]]
                top = weight.max()
                ahead[low + i] = top + math.log(np.exp(weight - top).sum())
            blocks.append((code[low:high], row, size, piece, score + ahead[to] - ahead[row + low]))
        for block in reversed(blocks):
            self._add(*block)


class _Index(dict):
    """Number of each word, given when it is first met; words are named without the space that each begins with."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def _appended(table: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """The first ``n`` values of a table and ``values``, with room for more if the table must grow."""
    if n + len(values) > len(table):
        grown = np.empty((n + len(values)) * 5 // 4, table.dtype)
        grown[:n] = table[:n]
        table = grown
    table[n : n + len(values)] = values
    return table


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(seed: np.ndarray, *place) -> np.ndarray:
    """Numbers of 64 bits that depend on seed and place alone."""
    for p in place:
        seed = _mixed(seed + np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return seed


def _uniform_one(seed: int, place: int) -> float:
    """A number in (0, 1), of the hash of one place."""
    full = (1 << 64) - 1
    x = (seed + place * 0x9E3779B97F4A7C15 + 1) & full
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & full
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & full
    return (((x ^ (x >> 31)) >> 11) + 0.5) / 2.0**53


def _truncated(log_mass: float, bound: float, u: float) -> float:
    """Best perturbed score of a set of this mass, given that it is below ``bound``."""
    a, b = log_mass - bound, math.log(-math.log(u))
    return log_mass - (max(a, b) + math.log1p(math.exp(-abs(a - b))))


class _Path:
    """Steps (edge, word occurrence) of one segmentation and the log mass of each prefix."""

    __slots__ = ("edge", "occ", "before")

    def __init__(self, lattices: Lattices, edge: np.ndarray, occ: np.ndarray):
        self.edge, self.occ = edge, occ
        self.before = np.zeros(len(edge) + 1)
        np.cumsum(lattices.logp[edge], out=self.before[1:])


class _Search:
    """The queue of one text: sets of paths, each as (bound, path, from, to, edges taken).

    With no edges taken it is the set of paths that leave ``path`` between two steps, else those that leave it
    at one step by another edge than these.
    """

    def __init__(self, seed: int, first: _Path):
        self.seed, self.drawn = seed, 0
        self.queue: list[tuple] = []
        self.found = [(first, -math.log(-math.log(self._u())))]
        self._add_leaving(first, 0, len(first.edge), self.found[0][1])

    def _u(self) -> float:
        self.drawn += 1
        return _uniform_one(self.seed, self.drawn)

    def _add_leaving(self, path: _Path, a: int, b: int, bound: float) -> None:
        lost = path.before[b] - path.before[a]
        if lost < 0:
            self.queue.append((_truncated(float(path.before[a]) + math.log(-math.expm1(lost)), bound, self._u()), path, a, b, ()))

    def open_best(self, lattices: Lattices) -> tuple | None:
        """Open the best set: its bound, the path it leaves, the step and the edge it leaves by."""
        if not self.queue:
            return None
        best = max(range(len(self.queue)), key=lambda i: self.queue[i][0])
        bound, path, a, b, taken = self.queue.pop(best)
        t = a
        if not taken:
            lost = path.before[b] - path.before[a]
            level = path.before[a] + math.log(max(math.exp(lost) - math.expm1(lost) * self._u(), 5e-324))
            t = min(a + int(np.searchsorted(-path.before[a + 1 : b + 1], -level)), b - 1)
            self._add_leaving(path, a, t, bound)
            self._add_leaving(path, t + 1, b, bound)
            taken = (int(path.edge[t]),)
        row = int(lattices.row(path.edge[t]))
        first = int(lattices.first[row])
        odds = np.exp(lattices.logp[first : lattices.first[row + 1]])
        odds[[e - first for e in taken]] = 0
        cum = np.cumsum(odds)
        edge = min(int(np.searchsorted(cum, self._u() * cum[-1], side="right")), int(np.nonzero(odds)[0][-1]))
        odds[edge] = 0
        if (left := odds.sum()) > 0:
            self.queue.append((_truncated(float(path.before[t]) + math.log(left), bound, self._u()), path, t, t + 1, (*taken, first + edge)))
        return bound, path, t, first + edge

    def add(self, path: _Path, t: int, bound: float) -> None:
        self.found.append((path, bound))
        self._add_leaving(path, t + 1, len(path.edge), bound)

    def bound(self) -> float:
        """Perturbed score of the best path not found."""
        return max((q[0] for q in self.queue), default=-np.inf)


def _walk(lattices: Lattices, word: np.ndarray, start: np.ndarray, noise: np.ndarray):
    """Draw the rest of each word: steps (edge, occurrence) in the order of the occurrences."""
    length, base = lattices.length[word], lattices.base[word]
    at = np.nonzero(start < length)[0]
    row, base, noise, steps = base[at] + start[at], base[at], noise[at], []
    end = base + length[at]
    while len(at):
        edge = lattices.draw(row, _hashed(noise, row - base) >> np.uint64(32))
        steps.append((at, edge))
        row += lattices.size[edge]
        on = row < end
        at, row, base, end, noise = at[on], row[on], base[on], end[on], noise[on]
    counts = np.zeros(len(word), np.int64)
    for i, (at, _) in enumerate(steps):
        counts[at] = i + 1
    offset = np.concatenate([[0], np.cumsum(counts)])
    edges = np.empty(offset[-1], np.int64)
    for i, (at, edge) in enumerate(steps):
        edges[offset[at] + i] = edge
    return edges, np.repeat(np.arange(len(word)), counts), offset


def _ids(pieces: Pieces, lattices: Lattices, path: _Path) -> np.ndarray:
    ids = lattices.piece[path.edge]
    raw = np.nonzero(ids == _BYTES)[0]
    if not len(raw):
        return ids
    char = lattices.char[lattices.row(path.edge[raw])]
    if char.max() < 128:
        ids[raw] = pieces.bytes[char]
        return ids
    codes = [chr(c).encode("utf-8") for c in char]
    out = np.repeat(ids, np.where(ids == _BYTES, 0, 1) + np.bincount(raw, [len(c) for c in codes], len(ids)).astype(np.int64))
    out[out == _BYTES] = pieces.bytes[np.frombuffer(b"".join(codes), np.uint8)]
    return out


def segmentations(pieces: Pieces, texts: list[str], seeds: list[int], k: int | list[int]) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to ``k`` segmentations (ids, log odds, log odds of inclusion), in the order drawn.

    ``k`` is one number of 1 or more, or one for each text.
    """
    wanted = [k] * len(texts) if isinstance(k, int) else k
    lattices = pieces.lattices()
    words = [lattices.numbers(text) for text in texts]
    lattices.fill()
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    word = np.concatenate([np.zeros(0, np.int64), *words])
    number = np.arange(len(word)) - np.repeat(ends[:-1], np.diff(ends))
    seed = np.repeat(np.array(seeds, np.int64).view(np.uint64), np.diff(ends))
    edge, occ, offset = _walk(lattices, word, np.zeros(len(word), np.int64), _hashed(seed, 1, number))
    searches = []
    for i, s in enumerate(seeds):
        a, b = offset[ends[i]], offset[ends[i + 1]]
        searches.append(_Search(s & (2**64 - 1), _Path(lattices, edge[a:b], occ[a:b])))
    for turn in range(2, max(wanted, default=0) + 1):
        opened = [(i, *best) for i, s in enumerate(searches) if wanted[i] >= turn and (best := s.open_best(lattices))]
        if not opened:
            break
        spans, starts = [], []
        for i, _, path, t, e in opened:  # the word that the new edge stands in, and all words behind it
            o = int(path.occ[t])
            spans.append(np.arange(o, ends[i + 1]))
            starts.append(np.zeros(ends[i + 1] - o, np.int64))
            starts[-1][0] = lattices.row(e) - lattices.base[word[o]] + lattices.size[e]
        span = np.concatenate(spans)
        edge, occ, offset = _walk(lattices, word[span], np.concatenate(starts), _hashed(seed[span], turn, number[span]))
        border = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
        for j, (i, bound, path, t, e) in enumerate(opened):
            a, b = offset[border[j]], offset[border[j + 1]]
            new = _Path(lattices, np.concatenate([path.edge[:t], [e], edge[a:b]]), np.concatenate([path.occ[: t + 1], span[occ[a:b]]]))
            searches[i].add(new, t, bound)
    out = []
    for s in searches:
        rest = s.bound()
        out.append([(_ids(pieces, lattices, p), float(p.before[-1]), _log_included(p.before[-1], rest)) for p, _ in s.found])
    return out


def _log_included(log_odds: float, rest: float) -> float:
    """Log of 1 - exp(-exp(log_odds - rest))."""
    if rest == -np.inf:
        return 0.0
    x = log_odds - rest
    return float(x if x < -30 else np.log(-np.expm1(-np.exp(min(x, 30.0)))))


_LOADED: dict[str, Pieces] = {}


def loaded(model_file: str) -> Pieces:
    """One table for each worker process and model."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Pieces(model_file)
    return _LOADED[model_file]


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are worked out together, by their characters and samples."""
    start = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= BATCH_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows that go out together, by their ids."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > OUT_IDS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def sampled(docs: DataFrame, model_file: str, k: int | Column, seed: int = 1, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text", again: bool = False) -> DataFrame:
    """Up to ``k`` distinct segmentations of each whole text, one row for each, without a shuffle.

    Columns: doc_id, sample (from 1, in the order drawn), n_pieces, log_prob, log_inclusion, round_trip (whether the ids
    decode to the text, with the mark of a space read as a space), ids_sha256 (over the ids as 32-bit little-endian numbers)
    and, if asked for, ids. The noise is seeded by the row's doc_id, so equal rows have equal samples. A text
    with fewer segmentations gives them all, with inclusion 1; a null text counts as empty and has one
    segmentation, of no pieces. Other columns are not looked at. ``k``, 1 or more, may be a column, with a number for each
    row; with ``again`` each row gets exactly ``k`` samples, and a text with fewer segmentations begins again with its first.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.col(doc_id), F.lit(seed)).alias("seed"), (F.lit(k) if isinstance(k, int) else k).cast("int").alias("k"))
    schema = f"doc_id {dict(given.dtypes)['doc_id']}, sample int, n_pieces long, log_prob double, log_inclusion double, round_trip boolean, ids_sha256 string"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model_file)
        for batch in batches:
            wanted = batch.column("k").to_pylist()
            for a, b in _groups([n * (15 + k) // 16 for n, k in zip(pc.utf8_length(batch.column("text")).to_pylist(), wanted)]):
                texts, seeds = (batch.column(c).slice(a, b - a).to_pylist() for c in ("text", "seed"))
                made = segmentations(pieces, texts, seeds, wanted[a:b])
                if again:
                    made = [[samples[i % len(samples)] for i in range(n)] for samples, n in zip(made, wanted[a:b])]
                of = [i for i, samples in enumerate(made) for _ in samples]
                flat = [(n, *s) for samples in made for n, s in enumerate(samples, 1)]
                for low, high in _slices([len(f[1]) for f in flat]):
                    yield written(pieces, texts, batch.column("doc_id").slice(a, b - a), of[low:high], flat[low:high])

    def written(pieces: Pieces, texts: list[str], doc_ids: pa.Array, of: list[int], flat: list[tuple]) -> pa.RecordBatch:
        columns = [
            doc_ids.take(pa.array(of, pa.int64())),
            pa.array([f[0] for f in flat], pa.int32()),
            pa.array([len(f[1]) for f in flat], pa.int64()),
            pa.array([f[2] for f in flat], pa.float64()),
            pa.array([f[3] for f in flat], pa.float64()),
            pa.array([pieces.written(f[1])[1:] == texts[i].replace(SPACE, " ").encode() for i, f in zip(of, flat)], pa.bool_()),
            pa.array([hashlib.sha256(f[1].astype("<i4").tobytes()).hexdigest() for f in flat], pa.string()),
        ]
        names = ["doc_id", "sample", "n_pieces", "log_prob", "log_inclusion", "round_trip", "ids_sha256"]
        if with_ids:
            ends = np.cumsum([0, *(len(f[1]) for f in flat)]).astype(np.int32)
            ids = np.concatenate([np.zeros(0, np.int32), *(f[1] for f in flat)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return given.mapInArrow(run, schema)


def decoded(encoded: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of the ids; null for null ids."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model_file)
        for batch in batches:
            texts = [None if x is None else pieces.decoded(np.array(x, np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return encoded.mapInArrow(run, f"{', '.join(f'`{n}` {t}' for n, t in encoded.dtypes)}, decoded string")
