"""Exact ids of a tokenizers file at the speed of a word lookup.

Both kinds of pre-tokenisation used here never join a word to the next one across a single
blank or line feed, nor to a full stop or comma after it. So a text is cut there, each
different chunk is encoded once per task by the tokenizers library, and a text's ids are its
chunks' ids in order. Cutting, telling the different chunks of a step and putting ids in order
are done by Arrow: Python meets each different chunk of a step once. Chunks are cut only where that is exact; anything else (runs of
blanks, odd white space at an edge, runs of punctuation) stays inside one chunk that the
library encodes as it is."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level files cut a text into words.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Different chunks remembered by a task (about 150 bytes each); the rest is encoded anew per step.
REMEMBERED = 1_000_000
#: Characters encoded as one step.
STEP_CHARS = 4_000_000
#: From this many characters on a run of white space goes to the tokenizers library: tiktoken's
#: pattern overflows its stack on one of a million.
LONG_RUN = 100_000

#: What each first character of a chunk stands for is told by _literal.
_ITSELF, _STOP = "\n\n", "\x02"
_MARK = "\x01"
_EDGES_OK = re.compile(r"(?:\n|\x02)?\S(?:[\s\S]*\S)?")
_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)")
_BLANK_RUN = re.compile(r"(?<!\s)\s{%d}" % LONG_RUN)
#: A full stop or comma after other punctuation; one run of punctuation is one word. Four control
#: characters are white space for Python but not for the library.
_GLUED = re.compile(r"[.,](?<=[^\w\s].|_.|[\x1c-\x1f].)")
#: One word to the library and to any Unicode version, alone or between blanks; no letter here joins another.
_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+")


def _literal(chunk: str) -> str:
    """The piece of text that a chunk stands for where white space counts."""
    if chunk[:2] == _ITSELF:
        return chunk[2:]
    if chunk[0] == _STOP:
        return chunk[1:]
    return chunk if chunk[0] == "\n" else " " + chunk


class ByteEncoder:
    """A byte-level file (white space belongs to tokens) run by tiktoken, which merges by the
    ids of the file's own vocabulary and gives the tokenizers library's very ids. Texts with
    a run of white space that tiktoken cannot take are encoded by that library itself."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        # byte-level files write a byte as a character: printable ones as themselves, the others from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes([byte[c] for c in token]): i for token, i in vocab.items() if all(c in byte for c in token) and not token.startswith("<|")}
        self.bpe = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        return [self._one(t) if t else b"" for t in texts]

    def _one(self, text: str) -> bytes:
        if len(text) >= LONG_RUN and _BLANK_RUN.search(text):
            self.library = self.library or Encoder(self.path, True)
            return self.library.whole(text).tobytes()
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()


class Encoder:
    """A file run by the tokenizers library. ``blanks_kept``: white space belongs to tokens
    (byte-level); else it only separates, and capital letters count as lower-case ones."""

    def __init__(self, path: str, blanks_kept: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.blanks_kept = blanks_kept
        self.known: dict[str, bytes] = {}
        if blanks_kept:  # a byte-level token's characters stand for one byte each
            size = self.tokenizer.get_vocab_size()
            self.width = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        else:
            self.mark = self.whole(_MARK)
            if len(self.mark) != 1:
                raise ValueError("the mark is not a token of its own")
            suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
            size = self.tokenizer.get_vocab_size()
            self.ends_word = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks, many as one text, and remember each one's ids."""
        known = self.known
        rest = []
        if not self.blanks_kept:
            words, others = [], []
            for c in chunks:
                (words if _LETTERS.fullmatch(c) else others).append(c)
            chunks = others
            for i in range(0, len(words), 20_000):
                part = words[i:i + 20_000]
                ids = self.whole(" ".join(part))
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                if len(ends) != len(part):  # the file does not tell where words end
                    chunks += part
                    continue
                self._remember(part, ids, np.concatenate([[0], ends[:-1]]), ends)
        for c in chunks:
            if (c[:2] == _ITSELF or c[:1] == _STOP) if self.blanks_kept else _MARK in c:
                known[c] = self.whole(_literal(c) if self.blanks_kept else c).tobytes()
            else:
                rest.append(c)
        for i in range(0, len(rest), 20_000):
            part = rest[i:i + 20_000]
            if self.blanks_kept:
                literal = [_literal(c) for c in part]
                ids = self.whole("".join(literal))
                upto = np.cumsum([len(x.encode()) for x in literal])
                ends = np.searchsorted(np.cumsum(self.width[ids]), upto, side="left") + 1
                starts = np.concatenate([[0], ends[:-1]])
            else:
                ids = self.whole(f" {_MARK} ".join([*part, ""]))
                ends = np.flatnonzero(ids == self.mark[0])
                starts = np.concatenate([[0], ends[:-1] + 1])
            self._remember(part, ids, starts, ends)

    def _remember(self, chunks: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = ids.tobytes()
        for c, a, b in zip(chunks, (4 * starts).tolist(), (4 * ends).tolist()):
            self.known[c] = raw[a:b]

    def _spaced(self, text: str) -> str:
        """``text`` with its chunks between single blanks."""
        apart = _GLUED.search(text) is None
        if self.blanks_kept:
            text = text.replace("\n", " \n")
            if apart:
                text = text.replace(".", " \x02.").replace(",", " \x02,")
            return _ITSELF + text
        try:
            text.encode("latin-1")  # no marks that join a letter or that a letter turns into
        except UnicodeEncodeError:
            return text.replace("\n", " ")
        text = text.lower().replace("\n", " ")
        if apart:
            text = text.replace(".", " .").replace(",", " ,")
        return text

    def _safe(self, text: str) -> list[str]:
        return [_ITSELF + c for c in _CUTS.split(text)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        safe = [self.blanks_kept and bool(t) and _STOP in t for t in texts]
        counts, chunks, different = self._cut(texts, safe)
        known, before = self.known, len(self.known)
        new = [c for c in different if c not in known]
        if self.blanks_kept and new:
            odd = {c for c in new if c[:2] != _ITSELF and not _EDGES_OK.fullmatch(c)}
            odd |= {c for c in new if c[:2] == _ITSELF and len(c) > 2 and not _EDGES_OK.fullmatch(c[2:])}
            if odd:
                safe = [s or bool(t) and not odd.isdisjoint(self._spaced(t).split(" ")) for t, s in zip(texts, safe)]
                counts, chunks, different = self._cut(texts, safe)
                new = [c for c in different if c not in known]
        self._learn(new)
        ids = pa.array([known[c] for c in different], pa.large_binary()).take(chunks.indices)
        if len(known) > REMEMBERED:
            for c in list(known)[max(before, REMEMBERED):]:
                del known[c]
        if not len(ids):
            return [b""] * len(texts)
        _, offsets, data = ids.buffers()  # of all ids in order, and where each chunk's begin
        ends = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(counts)])].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]

    def _cut(self, texts: list[str | None], safe: list[bool]):
        """The number of each text's chunks, all chunks in order as places among the different ones, and these."""
        spaced = pa.array([self._spaced(t) if t and not s else None for t, s in zip(texts, safe)], pa.large_string())
        lists = pc.split_pattern(spaced, " ")
        if any(safe):
            lists = pa.array([self._safe(t) if s else x for t, s, x in zip(texts, safe, lists.to_pylist())], lists.type)
        chunks = lists.flatten().dictionary_encode()
        counts = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        return counts, chunks, chunks.dictionary.to_numpy(zero_copy_only=False).tolist()


_ENCODERS: dict[tuple[str, bool], Encoder | ByteEncoder] = {}


def encoder(path: str, blanks_kept: bool) -> Encoder | ByteEncoder:
    """The encoder of this worker process; what it remembers serves all its tasks."""
    if (path, blanks_kept) not in _ENCODERS:
        _ENCODERS[path, blanks_kept] = ByteEncoder(path) if blanks_kept else Encoder(path, blanks_kept)
    return _ENCODERS[path, blanks_kept]


class _Whole:
    """``encoder`` with the file's added tokens (as ``<|endoftext|>``) read as the library reads
    them by default: texts that hold one are encoded by the unchanged library."""

    def __init__(self, path: str, blanks_kept: bool):
        self.plain, self.library = encoder(path, blanks_kept), Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        holds = [bool(t) and any(x in t for x in self.added) for t in texts]
        out = self.plain.encode([None if h else t for t, h in zip(texts, holds)])
        for i, h in enumerate(holds):
            if h:
                out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out


_DOCUMENTS: dict[tuple[str, bool], _Whole] = {}


def document_encoder(path: str, blanks_kept: bool) -> _Whole:
    """As ``encoder``, with added tokens as the library reads them by default."""
    if (path, blanks_kept) not in _DOCUMENTS:
        _DOCUMENTS[path, blanks_kept] = _Whole(path, blanks_kept)
    return _DOCUMENTS[path, blanks_kept]
