"""SentencePiece encoding and decoding by a batched Viterbi pass in numpy.

Text is cut where no piece of the vocabulary spans two neighbouring characters, which no segmentation can cross. The
distinct cuts of a batch are encoded by length: all words of one length advance together, one end position at a time.
Hashes of the substrings that end there probe the sorted hashes of the pieces, and the best one is stored with a
backpointer. What "best" means depends on the model:

* unigram: the largest sum of piece scores, as in the classic pass.
* bpe: scores are merge ranks, whose sum says nothing about the merges' outcome. Here a piece may follow the last piece
  of a prefix only if no merge would have joined characters across them first; under that rule each prefix has exactly
  one last piece, and the path is what the merges give.

A word of LONG characters or more (a text without a cut) has few others of its length to advance with. Its substrings and
its pairs of neighbouring pieces are looked up for many end positions at once, and only the choice goes from one end
position to the next, so its time is linear too. Lookups go by two independent 64-bit hashes; words found in the cache
are compared character by character.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_batch, chunks, table, text_bytes, tidy
from .decontaminate import word_hashes

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_NONE = np.int64(1 << 40)
_KEPT = 1 << 18
#: Characters that are compared at once.
_COMPARED = 1 << 17
#: Words from this length on are encoded one by one, unless so many have the same length; their end positions in slices.
LONG, _MANY, _SLICE = 256, 64, 1 << 15
#: Multipliers of the two hashes of a substring.
_MULTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _hash_columns(x: np.ndarray, mult: np.uint64 = _MULTS[0]) -> np.ndarray:
    """Prefix hashes of the rows of a matrix of code points; column j is of the first j."""
    out = np.zeros((len(x), x.shape[1] + 1), np.uint64)
    for j in range(x.shape[1]):
        out[:, j + 1] = out[:, j] * mult + x[:, j] + np.uint64(1)
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... (size of them) of each range, one range after another."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


@dataclass
class Pieces:
    """A vocabulary by number: single characters first, then longer pieces in the order of their scores."""

    strings: list[str]
    scores: np.ndarray
    ids: np.ndarray  # of each number; -1 for a character that is no piece
    byte_ids: np.ndarray
    unk: int
    bpe: bool
    singles: int = 0
    keys: np.ndarray = field(default=None)
    numbers: np.ndarray = field(default=None)
    hashes: np.ndarray = field(default=None)
    checks: np.ndarray = field(default=None)  # the second hash of each piece
    sizes: np.ndarray = field(default=None)
    usable: np.ndarray = field(default=None)
    left: np.ndarray = field(default=None)
    right: np.ndarray = field(default=None)
    powers: tuple[np.ndarray, np.ndarray] = field(default=None)
    maybe: np.ndarray = field(default=None)
    kind: np.ndarray = field(default=None)
    joined: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        self.singles = sum(len(s) == 1 for s in self.strings)
        self.sizes = np.array([len(s) for s in self.strings], np.int64)
        self.longest = int(self.sizes.max())
        points = np.zeros((len(self.strings), self.longest), np.uint64)
        for i, s in enumerate(self.strings):
            points[i, : len(s)] = [ord(c) for c in s]
        self.hashes, self.checks = (_hash_columns(points, m)[np.arange(len(points)), self.sizes] for m in _MULTS)
        order = np.argsort(self.hashes)
        self.keys, self.numbers = self.hashes[order], order.astype(np.int64)
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have one hash")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.powers = tuple(np.cumprod(np.r_[np.uint64(1), np.full(self.longest, m, np.uint64)]) for m in _MULTS)
        # neighbours that some piece holds, by classes of characters
        chars = sorted({c for s in self.strings if len(s) > 1 for c in s})
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for s in self.strings:
            k = self.kind[[ord(c) for c in s]]
            self.joined[k[:-1], k[1:]] = True
        self.usable = np.ones(len(self.strings), bool)
        if self.bpe:
            self._find_merges()

    def find(self, h: np.ndarray, check: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Numbers of the pieces with these hashes, else _NONE; check gives the second hashes at flat places of h."""
        out = np.full(h.shape, _NONE)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        probe = h.ravel()[at]
        place = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[place] == probe)
        at, number = at[hit], self.numbers[place[hit]]
        same = self.checks[number] == check(at)
        out.ravel()[at[same]] = number[same]
        return out

    def _find_merges(self) -> None:
        """The last merge that makes each longer piece; a piece that merges never make is not usable."""
        self.left, self.right = np.arange(len(self.strings)), np.arange(len(self.strings))
        for size in range(2, self.longest + 1):
            mine = np.flatnonzero(self.sizes == size)
            if not len(mine):
                continue
            points = np.array([[ord(c) for c in self.strings[i]] for i in mine], np.uint64)
            h, g = (_hash_columns(points, m) for m in _MULTS)
            made = np.zeros(len(mine), bool)
            for k in range(1, size):
                rest = [x[:, size] - x[:, k] * p[size - k] for x, p in zip((h, g), self.powers)]
                a, b = self.find(h[:, k], lambda at: g[at, k]), self.find(rest[0], lambda at: rest[1][at])
                ok = np.flatnonzero(~made & (a < mine) & (b < mine))
                ok = ok[self.usable[a[ok]] & self.usable[b[ok]]]
                ok = ok[self.fits(a[ok], b[ok], mine[ok])]
                self.left[mine[ok]], self.right[mine[ok]] = a[ok], b[ok]
                made[ok] = True
            self.usable[mine[~made]] = False

    def fits(self, a: np.ndarray, b: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Whether merges leave piece a beside piece b; merges from number below on don't count.

        The merges that made a and b are undone from the last on; at each step, a merge across the border must not
        come before the one just undone (of equal ones, the left one comes first)."""
        out = np.ones(len(a), bool)
        on, a, b, limit = np.arange(len(a)), a.copy(), b.copy(), below.copy()
        while len(on):
            joined = lambda x, p, i: x[a[i]] * p[self.sizes[b[i]]] + x[b[i]]  # noqa: B023, E731
            across = self.find(joined(self.hashes, self.powers[0], slice(None)), lambda at: joined(self.checks, self.powers[1], at))
            bad = (across < limit) & (self.sizes[a] + self.sizes[b] <= self.longest)
            out[on[bad]] = False
            more = ~bad & (np.maximum(a, b) >= self.singles)
            on, a, b, limit = on[more], a[more], b[more], limit[more]
            undo = a > b
            limit = np.where(undo, a, b + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return out

    def encode_equal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length (a row of code points each): all ids end to end, and how many each word has."""
        n, size = points.shape
        if size >= LONG and n < _MANY:
            each = [self.walk(p) for p in points]
            numbers = np.concatenate(each)
            return self._ids(numbers, points, np.array([len(x) for x in each], np.int64))
        h, g = (_hash_columns(points.astype(np.uint64), m) for m in _MULTS)
        back = np.zeros((n, size + 1), np.int64)  # size of the last piece of each prefix
        last = np.full((n, size + 1), _NONE)  # and its number
        best = np.zeros((n, size + 1))
        worst = (self.scores.min() if len(self.scores) else 0.0) - 10
        every = np.arange(n)
        for j in range(1, size + 1):
            spans = np.arange(min(j, self.longest), 0, -1)

            def check(at: np.ndarray, j: int = j, spans: np.ndarray = spans) -> np.ndarray:
                row, span = at // len(spans), spans[at % len(spans)]
                return g[row, j] - g[row, j - span] * self.powers[1][span]

            found = self.find(h[:, j][:, None] - h[:, j - spans] * self.powers[0][spans], check)
            known = found < _NONE
            if self.bpe:
                open_ = np.ones(n, bool)
                for c, span in enumerate(spans):
                    row = np.flatnonzero(open_ & known[:, c])
                    row = row[self.usable[found[row, c]]]
                    if span < j and len(row):
                        row = row[self.fits(last[row, j - span], found[row, c], np.full(len(row), _NONE))]
                    open_[row] = False
                    last[row, j], back[row, j] = found[row, c], span
                back[open_, j] = 1  # a character that is in no piece
            else:
                score = np.where(known, self.scores[np.where(known, found, 0)], -np.inf)
                score[:, -1] = np.where(known[:, -1], score[:, -1], worst)
                score += best[:, j - spans]
                pick = score.argmax(axis=1)
                best[:, j], back[:, j], last[:, j] = score[every, pick], spans[pick], found[every, pick]
        out, count, at = np.full((n, size), -1, np.int64), np.zeros(n, np.int64), np.full(n, size)
        while (on := np.flatnonzero(at)).size:
            out[on, size - 1 - count[on]] = last[on, at[on]]
            count[on] += 1
            at[on] -= back[on, at[on]]
        return self._ids(out[np.arange(size) >= size - count[:, None]], points, count)

    def walk(self, points: np.ndarray) -> np.ndarray:
        """The numbers of one long word's pieces, in order.

        Pieces that end at each position, and whether they may follow each other, are looked up a slice at a time."""
        n, most, base = len(points), self.longest, len(self.strings) + 1
        last, best = np.zeros(n + 1, np.int64), [0.0]
        tail: list[int] = [-1]  # last pieces of the latest prefixes
        fit: dict[int, bool] = {}
        unknown = base - 1
        sizes, scores = [*self.sizes.tolist(), 1], [*self.scores.tolist(), (self.scores.min() if len(self.scores) else 0.0) - 10]
        for a in range(0, n, _SLICE):
            b, lead = min(n, a + _SLICE), min(a, 2 * most)
            x = points[a - lead : b].astype(np.uint64) + np.uint64(1)
            found = np.full((most, len(x)), _NONE)  # by span less one, and end position
            h = [np.zeros(len(x) + 1, np.uint64) for _ in _MULTS]
            for s in range(min(most, len(x))):
                h = [np.r_[np.uint64(0), y[:-1] * m + x] for y, m in zip(h, _MULTS)]
                found[s, s:] = self.find(h[0][1 + s :], lambda at: h[1][1 + s + at])  # noqa: B023
            known = found < _NONE
            if self.bpe:
                known[known] = self.usable[found[known]]
                self._follow(found, known, base, fit)
            place, span = np.nonzero(known[::-1, lead:].T)
            numbers = found[most - 1 - span, lead + place].tolist()
            first = np.searchsorted(place, np.arange(b - a + 1)).tolist()
            j0 = a - len(tail) + 1  # the prefix that tail begins with
            for j in range(a + 1, b + 1):
                pick, top = unknown, -math.inf
                for number in numbers[first[j - a - 1] : first[j - a]]:
                    size = sizes[number]
                    if self.bpe:
                        if size == j or fit.get(tail[j - size - j0] * base + number):
                            pick = number
                            break
                    elif (score := best[j - size - j0] + scores[number]) > top:
                        pick, top = number, score
                if pick == unknown and not self.bpe:
                    top = best[j - 1 - j0] + scores[unknown]
                tail.append(pick)
                best.append(top)
            last[a + 1 : b + 1] = tail[a + 1 - j0 :]
            tail, best = tail[-most:], best[-most:]
        out, at, step = [], n, [*sizes]
        while at:
            number = int(last[at])
            out.append(number)
            at -= step[number]
        out = np.array(out[::-1], np.int64)
        return np.where(out == unknown, _NONE, out)

    def _follow(self, found: np.ndarray, known: np.ndarray, base: int, fit: dict[int, bool]) -> None:
        """Adds to fit whether pieces that end where others of these begin may follow them."""
        pairs = []
        for s in range(len(found)):
            at = np.flatnonzero(known[s])
            at = at[at > s]
            for t in range(len(found)):
                on = at[known[t, at - s - 1]]
                if len(on):
                    pairs.append(np.unique(found[t, on - s - 1] * base + found[s, on]))
        if not pairs:
            return
        new = np.array([p for p in np.unique(np.concatenate(pairs)).tolist() if p not in fit], np.int64)
        fit.update(zip(new.tolist(), self.fits(new // base, new % base, np.full(len(new), _NONE)).tolist()))

    def _ids(self, numbers: np.ndarray, points: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.where(numbers < _NONE, self.ids[np.where(numbers < _NONE, numbers, 0)], -1)
        return self._fallback(ids, numbers, points, count)

    def _fallback(self, ids: np.ndarray, numbers: np.ndarray, points: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become their UTF-8 bytes, or the unknown id in a vocabulary without bytes."""
        lost = np.flatnonzero(ids < 0)
        if not len(lost):
            return ids, count
        word = np.repeat(np.arange(len(count)), count)
        sizes = np.where(numbers < _NONE, self.sizes[np.where(numbers < _NONE, numbers, 0)], 1)
        ends = np.cumsum(sizes) - points.shape[1] * word - sizes
        out, at, count = [], 0, count.copy()
        for i in lost:
            raw = chr(points[word[i], ends[i]]).encode()
            new = self.byte_ids[list(raw)] if len(self.byte_ids) else np.array([self.unk])
            out += [ids[at:i], new]
            count[word[i]] += len(new) - 1
            at = i + 1
        return np.concatenate([*out, ids[at:]]), count


def _tile(points: np.ndarray, start: np.ndarray, length: np.ndarray) -> bool:
    """Whether the words at these places, one after another, are points; they are laid out a part at a time."""
    ends = np.cumsum(length)
    i, done = 0, 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, done + _COMPARED, "right")))
        if (points[ragged(start[i:j], length[i:j])] != points[done : ends[j - 1]]).any():
            return False
        i, done = j, int(ends[j - 1])
    return True


class Encoder:
    """Encodes batches of texts; keeps the ids of the first _KEPT distinct words it meets, and the words themselves."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.keys, self.ids, self.words = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.start, self.size, self.at, self.length = (np.zeros(0, np.int64) for _ in range(4))

    def _known(self, points: np.ndarray, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the cache of words with these keys, and which of them are the same words."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = np.flatnonzero(at < len(self.keys))
        inside = inside[(self.keys[at[inside]] == keys[inside]) & (self.length[at[inside]] == length[inside])]
        if len(inside):
            n = length[inside]
            same = self.words[ragged(self.at[at[inside]], n)] == points[ragged(start[inside], n)]
            known[inside] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        return at, known

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (int32) end to end, and the n + 1 bounds of the texts' ids. Null and empty texts have none."""
        p = self.pieces
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        bounds = np.cumsum([0, *map(len, marked)])
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        cut = np.ones(len(points), bool)
        kind = p.kind[points]
        cut[1:] = ~p.joined[kind[:-1], kind[1:]]
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        start = np.flatnonzero(cut)
        end = np.r_[start[1:], len(points)]
        keys, first, word = np.unique(word_hashes(points, start, end), return_index=True, return_inverse=True)
        length = end - start
        alike = bool((length[first[word]] == length).all()) and _tile(points, start[first[word]], length)
        if not alike:  # two words of one hash: words are told apart by themselves, and the cache is left alone
            named: dict[bytes, int] = {}
            word = np.array([named.setdefault(points[a:b].tobytes(), len(named)) for a, b in zip(start, end)])
            keys, first = np.unique(word, return_index=True)
            keys = keys.astype(np.uint64)
        at, known = self._known(points, keys, start[first], length[first]) if alike else (np.zeros(len(keys), np.int64), np.zeros(len(keys), bool))
        where, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        where[known], size[known] = self.start[at[known]], self.size[at[known]]
        new, ids, used = np.flatnonzero(~known), [self.ids], len(self.ids)
        lengths = length[first[new]]
        for n in np.unique(lengths):
            rows = new[lengths == n]
            got, count = p.encode_equal(points[start[first[rows]][:, None] + np.arange(n)])
            where[rows], size[rows] = used + np.cumsum(count) - count, count
            ids.append(got)
            used += len(got)
        pool = np.concatenate(ids)
        kept = new[lengths < LONG]
        if alike and len(self.keys) < _KEPT and len(kept):
            self._keep(points, keys[kept], where[kept], size[kept], start[first[kept]], length[first[kept]], pool)
        total = np.r_[0, np.cumsum(size[word])]
        return pool[ragged(where[word], size[word])].astype(np.int32), total[np.searchsorted(start, bounds)]

    def _keep(
        self, points: np.ndarray, keys: np.ndarray, where: np.ndarray, size: np.ndarray, start: np.ndarray, length: np.ndarray, pool: np.ndarray
    ) -> None:
        """Adds words with their keys and the places of their ids in pool; a key that is there already stays as it is."""
        fresh = ~np.isin(keys, self.keys)
        keys, where, size, start, length = (x[fresh] for x in (keys, where, size, start, length))
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(size) - size]
        self.at = np.r_[self.at, len(self.words) + np.cumsum(length) - length]
        self.ids = np.r_[self.ids, pool[ragged(where, size)]]
        self.words = np.r_[self.words, points[ragged(start, length)]]
        self.size, self.length, keys = np.r_[self.size, size], np.r_[self.length, length], np.r_[self.keys, keys]
        order = np.argsort(keys)
        self.keys, self.start, self.size, self.at, self.length = (x[order] for x in (keys, self.start, self.size, self.at, self.length))


class Decoder:
    """Turns ids into UTF-8 bytes; control pieces are empty, and the space put before a text goes."""

    def __init__(self, byte_strings: list[bytes]) -> None:
        self.size = np.array([len(b) for b in byte_strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(byte_strings), np.uint8)

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        size = self.size[ids]
        raw = self.data[ragged(self.start[ids], size)].tobytes()
        at = np.r_[0, np.cumsum(size)][bounds]
        return [raw[a + (raw[a : a + 1] == b" ") : b].decode(errors="replace") for a, b in zip(at, at[1:])]


def load(path: str) -> tuple[Pieces, list[bytes]]:
    """The vocabulary of a model file without normalisation (a space before each text, spaces kept), and the bytes that
    each id stands for."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.normalize(" ﬁ  A ") != SPACE + " ﬁ  A ".replace(" ", SPACE):
        raise ValueError("only models without normalisation can be used")
    n = sp.get_piece_size()
    names, special = [sp.id_to_piece(i) for i in range(n)], {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
    byte_ids = np.array([i for i in range(n) if sp.is_byte(i)], np.int64)
    # a byte-fallback vocabulary lists its bytes in order
    text = {i: names[i] for i in range(n) if i not in special and not sp.is_byte(i) and not sp.is_unused(i)}
    score = {i: sp.get_score(i) for i in text}
    bpe = all(s == int(s) for s in score.values())  # ranks; logarithms of probabilities are not whole
    raw = [b" \xe2\x81\x87 " if sp.is_unknown(i) else b"" if i in special else names[i].replace(SPACE, " ").encode() for i in range(n)]
    for b, i in enumerate(byte_ids):
        raw[i] = bytes([b])
    return vocabulary(text, score, bpe, byte_ids, sp.unk_id()), raw


def vocabulary(text: dict[int, str], score: dict[int, float], bpe: bool, byte_ids: np.ndarray, unk: int) -> Pieces:
    """Pieces from id -> string and id -> score."""
    single = {s: i for i, s in text.items() if len(s) == 1}
    chars = [*single, *sorted({c for s in text.values() for c in s} - set(single))]
    longer = sorted((i for i, s in text.items() if len(s) > 1), key=lambda i: (-score[i], i))
    ids = [single.get(c, -1) for c in chars] + longer
    least = min(score.values(), default=0.0) - 10
    return Pieces(
        chars + [text[i] for i in longer], np.array([score.get(i, least) for i in ids]), np.array(ids, np.int64), np.asarray(byte_ids, np.int64), unk,
        bpe
    )


def _texts(docs: DataFrame, path: str):
    """The model, sent to the workers once; its size is that of the vocabulary."""
    return docs.sparkSession.sparkContext.broadcast(load(path))


def _encoded(batch: pa.RecordBatch, at: int, to_ids: Encoder, to_text: Decoder) -> Iterator[tuple[pa.RecordBatch, pa.Array, pa.Array]]:
    """Parts of a batch, the ids of their texts (column at), and whether these give the texts again."""
    for i, j in chunks(text_bytes(batch.column(at))[1]):
        part = batch.slice(i, j - i)
        texts = part.column(at).to_pylist()
        ids, bounds = to_ids(texts)
        same = [a == (t or "").replace(SPACE, " ") for a, t in zip(to_text(ids, bounds), texts)]
        yield part, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)), pa.array(same)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, same for each row of docs(doc_id, text); same says that decoding gave the text.

    Null and empty texts have no ids; U+2581 is a space to the format and comes back as one; rows that repeat give a
    row each; an empty table gives none. Long texts are cut to words as well, so memory follows a batch's bytes."""
    sent = _texts(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_text = Encoder(sent.value[0]), Decoder(sent.value[1])
        for batch in batches:
            for part, lists, same in _encoded(batch, 1, to_ids, to_text):
                sizes = lists.value_lengths().cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, lists, same], ["doc_id", "n_pieces", "piece_ids", "same"])

    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keys.mapInArrow(tidy(run), "doc_id long, n_pieces long, piece_ids array<int>, same boolean")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows(doc_id, piece_ids); null ids give a null text."""
    sent = _texts(rows, path)

    def kernel(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = [x or [] for x in batch.column(1).to_pylist()]
        bounds = np.cumsum([0, *map(len, lists)])
        texts = Decoder(sent.value[1])(np.array([i for x in lists for i in x], np.int64), bounds)
        null = batch.column(1).is_null().to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if z else t for z, t in zip(null, texts)], pa.string())], ["doc_id", "text"]
        )

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "piece_ids").mapInArrow(by_batch(kernel), "doc_id long, text string")


def with_pieces(docs: DataFrame, path: str) -> DataFrame:
    """docs with the columns piece_ids, the ids of text, and same, which says that decoding them gave the text (columns of
    these names give way); all rows and all other columns stay.

    Null and empty texts have no ids and are the same; U+2581 is a space to the format and comes back as one; rows that
    repeat give a row each; an empty table gives none."""
    sent = _texts(docs, path)
    docs = docs.drop("piece_ids", "same")
    names, at = docs.columns, docs.columns.index("text")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema.fields)}, piece_ids array<int>, same boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_text = Encoder(sent.value[0]), Decoder(sent.value[1])
        for batch in batches:
            for part, lists, same in _encoded(batch, at, to_ids, to_text):
                yield pa.RecordBatch.from_arrays([*part.columns, lists, same], [*names, "piece_ids", "same"])

    return docs.mapInArrow(tidy(run), schema)


def op8_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, same for all of documents."""
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
