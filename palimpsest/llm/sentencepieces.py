"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text becomes the symbols of its characters (a blank is the model's blank sign, and one
stands before the text); characters that the model lacks become their UTF-8 bytes' pieces.
The agenda holds every pair of neighbouring symbols that is a piece; the pair of the best
score, the leftmost of equals, comes first and is merged, unless its keyed hash (of seed,
document and the pair's span) falls below the dropout rate: then it is skipped for good, and
only pairs that later merges make with its symbols come anew. Rate 0 gives the model's own
segmentation; any rate decodes to the very text.

No piece holds a blank sign after another sign, so words (blanks and what follows them)
never share a merge: all words of a step are worked on side by side, each with its own
agenda, as arrays; only words of over ``LONG`` characters have a heap of their own.

Defined results: null counts as empty; empty text gives the blank sign alone; a blank sign
in a text, and any character outside the model, travels as bytes; repeated rows are encoded
each (equal id and text: equally); an empty table gives no rows."""

from __future__ import annotations

import heapq
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import plain_columns, steps

#: Longest word worked on side by side with others; characters of such a step.
LONG, SIDE_BY_SIDE = 400, 200_000
_BLANK = "▁"
_NONE = np.iinfo(np.int64).max
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _skip(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit) -> np.ndarray:
    """True where the keyed hash of a candidate's two spans lies below the limit."""
    h = _mix(key + start.astype(_U) * _U(0x9E3779B97F4A7C15))
    h = _mix(h + (end.astype(_U) << _U(32)) + middle.astype(_U))
    return (h >> _U(11)) < limit


class Pieces:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.byte = np.zeros(256, np.int64)
        plain: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
                self.bytes_of.append(bytes([int(name[3:5], 16)]))
            elif special[i]:
                self.bytes_of.append(b"")
            else:
                plain[name] = i
                self.bytes_of.append(name.replace(_BLANK, " ").encode())
        if any(_BLANK in p.lstrip(_BLANK) for p in plain):
            raise ValueError("a piece holds a blank sign after another sign")
        self.char = np.full(0x110000, -1, np.int64)
        for name, i in plain.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        self.blank = plain[_BLANK]
        self.char[ord(" ")] = self.blank
        self.char[ord(_BLANK)] = -1
        scores = np.array([model.get_score(i) for i in range(n)])
        rank = np.empty(n, np.int64)
        rank[np.lexsort((np.arange(n), -scores))] = np.arange(n)
        self.rank, self.by_rank = rank, np.argsort(rank)
        # pairs of pieces that make a piece, in an open-addressed table
        made = {}
        for name, i in plain.items():
            for cut in range(1, len(name)):
                a, b = plain.get(name[:cut]), plain.get(name[cut:])
                if a is not None and b is not None:
                    made[a << 20 | b] = i
        self.pairs = dict(made)
        keys = np.fromiter(made, np.int64, len(made)).astype(_U)
        bits = (4 * len(keys)).bit_length()
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _NONE, np.int64)
        self.best = np.full(1 << bits, _NONE, np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        values = rank[np.fromiter(made.values(), np.int64, len(made))]
        while len(todo):
            free = self.keys[slot] == _NONE
            self.keys[slot[free]] = keys[todo[free]].astype(np.int64)
            won = self.keys[slot] == keys[todo].astype(np.int64)
            self.best[slot[won]] = values[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a pair makes, or ``_NONE``."""
        keys = (a << 20) | b
        slot = self._slot(keys.astype(_U))
        there = self.keys[slot]
        out = np.where(there == keys, self.best[slot], _NONE)
        out[(a < 0) | (b < 0)] = _NONE
        todo = np.flatnonzero((there != keys) & (there != _NONE) & (a >= 0) & (b >= 0))
        at = slot[todo]
        while len(todo):
            at = (at + 1) & self.mask
            there = self.keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = self.best[at[hit]]
            on = ~hit & (there != _NONE)
            todo, at = todo[on], at[on]
        return out

    def _side_by_side(self, ids: np.ndarray, starts: np.ndarray, place: np.ndarray, key: np.ndarray, limit) -> np.ndarray:
        """Symbols left (-2: merged into the one before) after all words' agendas are empty.
        ``starts``: of the words; ``place``, ``key``: of each symbol in its text, and of its document."""
        n = len(ids)
        ids = np.append(ids, -1)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        ends = np.append(starts[1:], n)
        after[ends - 1] = n  # n: no symbol
        before[starts] = n
        size = np.ones(n + 1, np.int64)
        best = self.merged(ids[:-1], ids[after])
        best[after == n] = _NONE
        # agenda order in one number: rank of the piece, then place
        agenda = np.where(best == _NONE, _NONE, (np.minimum(best, 1 << 24) << 32) | np.arange(n))
        # what is still worked on: each word's start in slots, the symbols' agendas, their numbers, and back
        words, slots, of, local = starts, agenda, np.arange(n), np.arange(n + 1)
        while len(words):
            top = np.minimum.reduceat(slots, words)
            open_ = top != _NONE
            if open_.mean() < 0.7:  # leave the finished words behind
                keep = np.repeat(open_, np.diff(np.append(words, len(slots))))
                lengths = np.diff(np.append(words, len(slots)))[open_]
                slots, of = slots[keep], of[keep]
                words = np.cumsum(lengths) - lengths
                local[of] = np.arange(len(of))
            top = top[open_]
            if not len(top):
                break
            left = top & 0xFFFFFFFF
            right = after[left]
            if limit:
                gone = _skip(key[left], place[left], place[right], place[left] + size[left] + size[right], limit)
                slots[local[left[gone]]] = _NONE
                left, right = left[~gone], right[~gone]
                rank = (top >> 32)[~gone]
            else:
                rank = top >> 32
            if not len(left):
                continue
            ids[left] = self.by_rank[rank]
            ids[right] = -2
            size[left] += size[right]
            next_ = after[right]
            after[left] = next_
            inner = next_ < n
            before[next_[inner]] = left[inner]
            slots[local[right]] = _NONE
            m = self.merged(ids[left], ids[next_])
            m[~inner] = _NONE
            slots[local[left]] = np.where(m == _NONE, _NONE, (np.minimum(m, 1 << 24) << 32) | left)
            prev = before[left]
            some = prev < n
            prev, here = prev[some], left[some]
            m = self.merged(ids[prev], ids[here])
            slots[local[prev]] = np.where(m == _NONE, _NONE, (np.minimum(m, 1 << 24) << 32) | prev)
        return ids[:-1]

    def _alone(self, ids: np.ndarray, place: np.ndarray, key: np.ndarray, limit) -> np.ndarray:
        """The same for one long word, with a heap."""
        n = len(ids)
        ids = ids.tolist()
        after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int):
            if a >= 0 and b < n:
                made = self.pairs.get(ids[a] << 20 | ids[b]) if ids[a] >= 0 and ids[b] >= 0 else None
                if made is not None:
                    heapq.heappush(heap, (int(self.rank[made]), a, size[a], size[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, a, wide, wide_b = heapq.heappop(heap)
            b = after[a]
            if ids[a] == -2 or size[a] != wide or b >= n or size[b] != wide_b:
                continue
            if limit and _skip(key[a:a + 1], place[a:a + 1], place[b:b + 1], place[a:a + 1] + wide + wide_b, limit)[0]:
                continue
            ids[a], ids[b] = int(self.by_rank[rank]), -2
            size[a] += size[b]
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return np.array(ids, np.int64)

    def encode(self, texts: list[str | None], keys: list[int], rate: float, seed: int) -> list[np.ndarray]:
        """Ids of each text; ``keys``: a number of each document."""
        limit = _U(int(rate * (1 << 53))) if rate > 0 else None
        whole = "".join([" " + (t or "") for t in texts])
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4").astype(np.int64)
        lengths = np.array([len(t or "") + 1 for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(len(codes)) - np.repeat(offsets[:-1], lengths)
        key = np.repeat(_mix(np.array(keys, np.int64).astype(_U) + _mix(np.full(len(keys), seed, np.int64).astype(_U))), lengths)
        ids = self.char[codes]
        blank = ids == self.blank
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[offsets[:-1]] = True
        words = np.flatnonzero(start)
        wide = np.diff(np.append(words, len(codes)))
        done = np.empty(len(codes), np.int64)
        long = np.flatnonzero(wide > LONG)
        for w in long.tolist():
            part = slice(words[w], words[w] + wide[w])
            done[part] = self._alone(ids[part], place[part], key[part], limit)
        cuts = np.unique(np.concatenate([long, long + 1, np.searchsorted(words, np.arange(0, len(codes), SIDE_BY_SIDE)), [0, len(words)]]))
        alone = set(long.tolist())
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if a in alone:
                continue
            part = slice(words[a], words[b] if b < len(words) else len(codes))
            done[part] = self._side_by_side(ids[part], words[a:b] - words[a], place[part], key[part], limit)
        left = done != -2
        of = np.repeat(np.arange(len(texts)), lengths)[left]
        out, chars = done[left], codes[left]
        lost = np.flatnonzero(out == -1)
        if len(lost):
            spelled = {c: self.byte[np.frombuffer(chr(c).encode(), np.uint8)] for c in np.unique(chars[lost]).tolist()}
            times = np.ones(len(out), np.int64)
            times[lost] = [len(spelled[c]) for c in chars[lost].tolist()]
            at = np.cumsum(times) - times
            out, of = np.repeat(out, times), np.repeat(of, times)
            filled = np.concatenate([spelled[c] for c in chars[lost].tolist()])
            where = np.repeat(at[lost], times[lost]) + np.arange(len(filled)) - np.repeat(np.cumsum(times[lost]) - times[lost], times[lost])
            out[where] = filled
        return np.split(out.astype(np.int32), np.searchsorted(of, np.arange(1, len(texts))))

    def decode(self, ids: np.ndarray) -> str:
        """The text whose ids these are, without the blank before it."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 20) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, ids, n_ids, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), decoded_sha256 (of the text decoded from the ids), lossless."""

    def run(batches):
        pieces = Pieces(model)
        for part in steps(batches, limit=1_000_000):
            texts = part.column(1).to_pylist()
            found = pieces.encode(texts, [x or 0 for x in part.column(0).to_pylist()], rate, seed)
            decoded = [pieces.decode(x) for x in found]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32())),
                 pa.array(np.diff(offsets), pa.int64()), pa.array([zlib.crc32(x.astype("<u4")) for x in found], pa.int64()),
                 pa.array([sha256(t.encode()).hexdigest() for t in decoded]), pa.array([d == (t or "") for d, t in zip(decoded, texts)])],
                names=["doc_id", "ids", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

    return plain_columns(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean")
