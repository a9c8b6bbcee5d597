"""Hierarchical multi-length packing of token ids into training sequences.

Documents are routed to context-size tiers (powers of two up to ``TIERS[-1]``): whole top windows are
cut off first, the rest goes to the smallest tier that holds it.  Each tier is packed in turn, long
ones first: a piece opens a window, and its gap is filled with the longest pieces of shorter tiers
that fit; when none fits exactly, one is cut, and what is left of it is routed again.  So windows are
full, at a power of two, but for the last one of each task.  Finally windows are dealt to step groups
of about equal numbers of tokens.

No shuffle: each task packs the documents that it reads, block by block, and takes what is left of a
block to the next.  Memory is bounded by ``BLOCK_IDS`` and the longest text.  Sequence ids are unique
over all tasks; a task that is run again makes the same ones.

Defined cases: null and empty texts are one piece with the end id alone; repeated rows and repeated
or null ids are packed as rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, table
from .tokens import blocks, encoder, released

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Ids that a task packs at a time.
BLOCK_IDS = 1 << 20
#: Bytes of texts that are encoded at a time.
PIECE = 1 << 19
#: Tokens of a step group, about.
STEP_TOKENS = 1 << 17

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Packer:
    """Packs rows of ids that come block by block. Pieces are (row, start, length)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(tiers[-1] + 1)]
        self.present = 0  # bit n: there are pieces of length n

    def put(self, row: int, start: int, length: int) -> None:
        self.by_length[length].append((row, start))
        self.present |= 1 << length

    def take(self, most: int, least: int = 1) -> tuple[int, int, int] | None:
        """The longest piece with a length from least to most."""
        found = self.present & ((1 << (most + 1)) - 1)
        n = found.bit_length() - 1
        if n < least:
            return None
        pieces = self.by_length[n]
        row, start = pieces.pop()
        if not pieces:
            self.present &= ~(1 << n)
        return row, start, n

    def take_longer(self, than: int) -> tuple[int, int, int] | None:
        """The shortest piece that is longer: the one to cut."""
        found = self.present >> (than + 1)
        if not found:
            return None
        return self.take(than + (found & -found).bit_length())

    def add(self, row: int, length: int) -> Iterator[list[tuple[int, int, int]]]:
        """Routes a row; gives its whole top windows."""
        top = self.tiers[-1]
        whole = length - length % top
        for start in range(0, whole, top):
            yield [(row, start, top)]
        if length > whole:
            self.put(row, whole, length - whole)

    def windows(self) -> Iterator[list[tuple[int, int, int]]]:
        """Full windows, tier by tier; what can't fill one stays."""
        for size in reversed(self.tiers):
            floor = size // 2 if size > self.tiers[0] else 0
            while (first := self.take(size, floor + 1)) is not None:
                window, gap = [first], size - first[2]
                while gap:
                    piece = self.take(gap)
                    if piece is None:
                        if (piece := self.take_longer(gap)) is None:
                            break
                        row, start, n = piece
                        self.put(row, start + gap, n - gap)
                        piece = (row, start, gap)
                    window.append(piece)
                    gap -= piece[2]
                if gap:
                    for piece in window:
                        self.put(*piece)
                    return
                yield window

    def rest(self) -> list[tuple[int, int, int]]:
        """All that is left, less than a top window."""
        out = []
        while (piece := self.take(self.tiers[-1])) is not None:
            out.append(piece)
        return out


def groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step group for each window: the largest ones first, each to the group with the fewest tokens."""
    n = max(1, round(sum(sizes) / step_tokens))
    heap, out = [(0, g) for g in range(n)], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, g = heap[0]
        out[i] = g
        heapq.heapreplace(heap, (tokens + sizes[i], g))
    return out


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, block_ids: int = BLOCK_IDS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit) and places; see the module."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted({*tiers}):
        raise ValueError("tiers must be rising powers of two")

    def work(batches):
        from pyspark import TaskContext

        encode, packer = encoder(tokenizer).encode, Packer(tiers)
        base = TaskContext.get().partitionId() << 36
        sequence = group = next_row = held = 0
        rows: dict[int, tuple[int | None, np.ndarray]] = {}

        def out(windows):
            nonlocal sequence, group
            step = groups([sum(p[2] for p in w) for w in windows], step_tokens)
            columns = [[] for _ in range(9)]
            for w, g in zip(windows, step):
                offset = 0
                size = sum(p[2] for p in w)
                tier = size if size in tiers else tiers[-1]
                for row, start, n in w:
                    doc_id, ids = rows[row]
                    for c, v in zip(columns, (doc_id, start, n, ids[start : start + n].tobytes(), len(ids), base + sequence, offset, tier, base + group + g)):
                        c.append(v)
                    offset += n
                sequence += 1
            group += max(step, default=-1) + 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"])

        top: list = []
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, _ in blocks(batch.column(1)):
                for k, m, texts in blocks(batch.column(1).slice(i, j - i), PIECE):
                    ids, n = encode(texts)
                    ends = np.cumsum(n)
                    for doc_id, a, b in zip(doc_ids[i + k : i + m], ends - n, ends):
                        rows[next_row] = (doc_id, np.append(ids[a:b], np.uint32(end_id)))
                        top += packer.add(next_row, len(rows[next_row][1]))
                        held += len(rows[next_row][1])
                        next_row += 1
                if held >= block_ids:
                    top += packer.windows()
                    yield out(top)
                    left, top = packer.rest(), []
                    for piece in left:
                        packer.put(*piece)
                    rows = {p[0]: rows[p[0]] for p in left}
                    held = 0
        top += packer.windows()
        if rest := packer.rest():
            # less than a window of their own tier: all of it once more, cut where a top window ends
            window, gap = [], tiers[-1]
            for row, start, n in rest:
                while n:
                    k = min(n, gap)
                    window.append((row, start, k))
                    start, n, gap = start + k, n - k, gap - k
                    if not gap:
                        top.append(window)
                        window, gap = [], tiers[-1]
            if window:
                top.append(window)
        if top:
            yield out(top)

    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").cast("binary").alias("text"))
    return texts.mapInArrow(released(work, encoders=True), SCHEMA)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per piece of each document of the whole table."""
    import public_tokenizers

    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")
