"""Pack token sequences by harmonic classes.

A document's tokens are cut into pieces whose lengths are the capacity or an
exact fraction 1/2, 1/4, ... of it, and one short rest.  Class k holds pieces
of lengths in (capacity/(k+1), capacity/k], and every bin of class k takes
exactly k of them; so a bin is filled without looking at other bins, and each
worker packs what it reads.  Bins still open when a worker ends are emptied
into common bins, largest piece first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tickwell.llm.frames import as_ids, whole_numbers

CAPACITY = 2048
END = 1
SMALLEST_CUT = 32  # fractions of the capacity below this stay one piece
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
WORKER_BITS = 36  # sequences a worker can number


def lengths_of(tokens: int, capacity: int = CAPACITY, smallest: int = SMALLEST_CUT) -> list[int]:
    """Piece lengths of a document, longest first."""
    whole, rest = divmod(tokens, capacity)
    pieces = [capacity] * whole
    part = capacity // 2
    while part >= smallest:
        if rest >= part:
            pieces.append(part)
            rest -= part
        part //= 2
    return [*pieces, rest] if rest else pieces


class Packer:
    """Bins of one worker; ``add`` and ``close`` give finished (sequence, offset, piece) rows."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.open, self.sequences = capacity, {}, 0

    def _finish(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            yield self.sequences, offset, piece
            offset += piece[2]
        self.sequences += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        """``piece`` is (document, start, length, ...)."""
        k = self.capacity // piece[2]
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            del self.open[k]
            yield from self._finish(held)

    def close(self) -> Iterator[tuple]:
        """Pieces of unfilled bins, first fit by falling length; at most k - 1 are left of each class."""
        rest = sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2])
        self.open = {}
        bins: list[tuple[int, list[tuple]]] = []
        for piece in rest:
            for i, (used, held) in enumerate(bins):
                if used + piece[2] <= self.capacity:
                    held.append(piece)
                    bins[i] = (used + piece[2], held)
                    break
            else:
                bins.append((piece[2], [piece]))
        for _, held in bins:
            yield from self._finish(held)


def load_encoder():
    """``encode(text) -> ids`` of the public byte-level vocabulary.

    Its rank file gives the ids of ``byte_bpe_50k.json`` four times faster; the
    tests compare both.
    """
    import base64

    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    return lambda text: coder.encode(text, allowed_special="all")


def pack(documents: DataFrame, capacity: int = CAPACITY, end: int | None = END, encoder=load_encoder) -> DataFrame:
    """One row per piece of ``SCHEMA``.

    A null text is empty and still has its end token; a null id stays null;
    repeated rows are packed each; an empty table gives no rows.  Only
    ``doc_id`` and ``text`` are read, whatever else the table holds.
    """
    def run(batches):
        import numpy as np
        from pyspark import TaskContext
        encode = encoder()
        first = TaskContext.get().partitionId() << WORKER_BITS
        packer = Packer(capacity)

        def frame(rows):
            rows = list(rows)
            out = pd.DataFrame([(start, size, crc, total, first + seq, offset) for seq, offset, (_, start, size, crc, total) in rows],
                               columns=[c.split()[0] for c in SCHEMA.split(", ")][1:])
            out.insert(0, "doc_id", whole_numbers([piece[0] for _, _, piece in rows]))
            return out

        for batch in batches:
            rows = []
            for doc, text in zip(as_ids(batch["doc_id"]), batch["text"], strict=True):
                ids = encode(text or "")
                if end is not None:
                    ids.append(end)
                raw = memoryview(np.asarray(ids, "<u4").tobytes())
                start = 0
                for size in lengths_of(len(ids), capacity):
                    crc = zlib.crc32(raw[4 * start:4 * (start + size)])
                    rows.extend(packer.add((doc, start, size, crc, len(ids))))
                    start += size
            yield frame(rows)
        yield frame(packer.close())

    return documents.selectExpr("cast(doc_id AS string) AS doc_id", "coalesce(text, '') AS text").mapInPandas(run, SCHEMA)
