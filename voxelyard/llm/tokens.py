"""Token ids of whole texts, by the ``tokenizers`` library, with each distinct chunk encoded once.

The word-level BPE vocabulary drops white space and never merges across it: its normaliser works
character by character and its splitter only keeps runs without white space.  The ids of a text are
therefore the ids of its white-space-free chunks, one after the other, and a chunk that occurs many
times has to go through the library only once per worker.  Chunks are cut at ASCII white space,
which every tokenizer of this kind treats as white space (a chunk may hold further, non-ASCII white
space; the library handles that); where a probe shows that the vocabulary is lower-case, letters are
lowered and marks parted from words first, so that fewer chunks are distinct.  ``tests/llm`` holds
this against encoding whole texts.

Null texts count as empty.  Memory is bounded: the chunk table is emptied beyond ``cache_chunks``.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks that a worker remembers before it starts its table afresh.
CACHE_CHUNKS = 600_000
#: Bytes that a task works on at a time.
BLOCK = 1 << 21
#: How the vocabulary marks a token that ends a word.
WORD_END = "</w>"


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(b" \t\n\v\f\r")] = True
#: 1 for ASCII letters (lower) and digits, 2 for ASCII marks but the apostrophe.
KIND = np.zeros(256, np.uint8)
KIND[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 1
KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = 2

# The usual alphabet of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the
# others, in order, for the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_ALPHABET = {b: 256 + n for n, b in enumerate(sorted({*range(256)} - _PRINTABLE)) if b != 32}

_ENCODERS: dict[tuple[str, int], "ChunkEncoder"] = {}


def encoder(path: str, cache_chunks: int = CACHE_CHUNKS) -> "ChunkEncoder":
    """The worker's encoder for a vocabulary file; kept between batches and tasks."""
    key = (path, cache_chunks)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, cache_chunks)
    return _ENCODERS[key]


class _Slots(dict):
    """Numbers chunks as they come; the new ones wait in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class ChunkEncoder:
    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.cache_chunks = cache_chunks
        vocabulary, self.word_end, self.lower = self.tokenizer.get_vocab(), None, False
        probe = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("Word WORD.", "word word .")]
        self.lower = probe[0] == probe[1]
        if self.lower and any(t.endswith(WORD_END) for t in vocabulary):
            self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
            self.word_end[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
            # for words that are lower-case and composed already, given as the alphabet of bytes
            self.words = Tokenizer.from_file(path)
            self.words.normalizer = normalizers.Sequence([])
            self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            with contextlib.suppress(AttributeError):  # each word comes once: the library's own table is in the way
                self.words.model._resize_cache(0)
        self._reset()

    def _reset(self) -> None:
        self.slot = _Slots()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for e in ids for i in e), np.uint32, int(n.sum())), n

    def _encode_words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that are one lower-case word each share calls, as the last id of a word is marked
        as its end. Where the marks don't add up, chunks are encoded one by one."""
        parts = [chunks[i : i + 256] for i in range(0, len(chunks), 256)]
        lines = [x if x.isascii() else x.encode().decode("latin-1").translate(BYTE_ALPHABET) for x in map(" ".join, parts)]
        ids, lengths = [], []
        for part, whole in zip(parts, self.words.encode_batch_fast(lines, add_special_tokens=False)):
            row = np.array(whole.ids, np.uint32)
            ends = np.flatnonzero(self.word_end[row])
            n = np.diff(ends, prepend=-1)
            if len(ends) != len(part) or ends[-1] != len(row) - 1:
                row, n = self._encode_chunks(part)
            ids.append(row)
            lengths.append(n)
        return np.concatenate(ids), np.concatenate(lengths)

    def _learn(self, chunks: list[bytes]) -> None:
        first = len(self.slot) - len(chunks)
        text = [c.decode("utf-8", "replace") for c in chunks]
        words, others = [], range(len(text))
        if self.word_end is not None:
            words = [i for i, t in enumerate(text) if t.isalpha() and (t.islower() if t.isascii() else t == t.lower() and unicodedata.is_normalized("NFC", t))]
            others = sorted({*others}.difference(words))
            words.sort(key=lambda i: not text[i].isascii())  # those that need no byte alphabet lie together
        while len(self.slot) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        for rows, encode in ((words, self._encode_words), (others, self._encode_chunks)):
            if rows:
                ids, n = encode([text[i] for i in rows])
                while self.used + len(ids) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
                at = first + np.array(rows)
                self.flat[self.used : self.used + len(ids)] = ids
                self.start[at] = self.used + np.cumsum(n) - n
                self.length[at] = n
                self.used += len(ids)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (uint32), and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        block = b"\n".join([t or b"" for t in texts])
        bounds = np.cumsum([len(t or b"") + 1 for t in texts])  # one past each text's line feed
        if self.lower and b"<|" not in block:  # no special token, whose spelling counts
            block = block.lower()
            raw = np.frombuffer(block, np.uint8)
            # between a letter or digit and a mark, no token goes on; an apostrophe may start one
            kind = KIND[raw]
            at = 1 + np.flatnonzero(kind[1:] + kind[:-1] == 3)
            block = np.insert(raw, at, 32).tobytes()
            bounds = bounds + np.searchsorted(at, bounds)
        raw = np.frombuffer(block, np.uint8)
        space = IS_SPACE[raw]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))  # starts and ends in turn
        starts = edge[::2]
        words = np.diff(np.searchsorted(starts, bounds), prepend=0)
        if len(self.slot) > self.cache_chunks:
            self._reset()
        # Arrow finds the block's distinct chunks, the table numbers those alone
        ends = np.concatenate([[0], np.cumsum(edge[1::2] - starts)])
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw[~space])]).dictionary_encode()
        own = _cells(chunks.dictionary)
        slots = np.fromiter(map(self.slot.__getitem__, own), np.int64, len(own))[chunks.indices.to_numpy()]
        if self.slot.fresh:
            self._learn(self.slot.fresh)
            self.slot.fresh = []
        n = self.length[slots]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.start[slots] - (ends - n), n)]
        return ids, np.diff(np.concatenate([[0], ends])[np.cumsum(words)], prepend=0)


def _cells(column: pa.Array) -> list[bytes]:
    """The values of a large_binary column without nulls or offset."""
    _, ends, raw = column.buffers()
    raw, ends = raw.to_pybytes() if raw else b"", np.frombuffer(ends, np.int64)[: len(column) + 1].tolist() if len(column) else [0]
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def blocks(column: pa.Array, most_bytes: int = BLOCK):
    """Cuts a column of binary texts into lists of about most_bytes each, one text at least: (from, to,
    texts). Only a block at a time leaves Arrow's memory."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield first, last, column.slice(first, last - first).to_pylist()
        first = last


def released(work, encoders: bool = False):
    """Wraps a function over batches so that a worker, which waits for its next task, gives back the
    memory that it no longer uses. Encoders that an earlier operator left in the worker go too, but for
    work that has use for them."""

    def held(batches):
        if not encoders:
            _ENCODERS.clear()
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # no such call but in glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return held
