"""Quartile bucket digests: short fingerprints of whole texts that stay alike when a text is edited.

The byte triplets of a text are hashed into buckets.  A digest holds, for each
bucket, how many of the three quartiles of all bucket counts its own count
exceeds (two bits), and the length on a logarithmic scale.  The difference of
two digests is the sum of the steps between their buckets and a bounded
penalty for unequal lengths, over the largest sum possible.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.frames import written

BUCKET_BITS = 10  # 1,024 buckets, 256 bytes of quartile codes
LENGTH_BASE = 1.1  # lengths a tenth apart are one step apart
LENGTH_STEPS = 10  # steps after which unequal lengths cost no more
LENGTH_SHARE = 1 / 16  # most that unequal lengths cost, against one step in every bucket
SLICE = 1 << 20  # bytes whose triplets are hashed at a time
MULTIPLIER = np.uint32(2654435761)


def bucket_counts(data: bytes, bits: int = BUCKET_BITS) -> np.ndarray:
    """How many byte triplets of ``data``, with two zero bytes at either end, fall into each bucket."""
    padded = np.frombuffer(b"\0\0" + data + b"\0\0", np.uint8)
    counts = np.zeros(1 << bits, np.int64)
    for at in range(0, len(padded) - 2, SLICE):
        part = padded[at:at + SLICE + 2].astype(np.uint32)
        triplets = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
        counts += np.bincount((triplets * MULTIPLIER) >> np.uint32(32 - bits), minlength=1 << bits)
    return counts


def fingerprint(text: str, bits: int = BUCKET_BITS) -> bytes:
    """Two bytes of length code, then four buckets a byte; equal texts have equal digests."""
    data = text.encode()
    counts = bucket_counts(data, bits)
    ordered = np.sort(counts)
    quartiles = ordered[[len(counts) // 4, len(counts) // 2, 3 * len(counts) // 4]]
    codes = (counts[:, None] > quartiles).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    length = round(math.log(len(data), LENGTH_BASE)) + 1 if data else 0
    return length.to_bytes(2, "big") + (codes << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for the largest difference; symmetric."""
    shifts = np.array([6, 4, 2, 0], np.uint8)
    x, y = ((np.frombuffer(d, np.uint8, offset=2)[:, None] >> shifts) & 3 for d in (a, b))
    steps = int(np.abs(x.astype(np.int16) - y).sum())
    apart = min(abs(int.from_bytes(a[:2], "big") - int.from_bytes(b[:2], "big")), LENGTH_STEPS)
    weight = x.size * LENGTH_SHARE * 3 / LENGTH_STEPS
    return 1.0 - (steps + weight * apart) / (3 * x.size + weight * LENGTH_STEPS)


def with_foreign_tail(text: str, other: str) -> str:
    """The last quarter of ``text`` (rounded down, in code points) replaced by the start of ``other``, as long if that is long enough."""
    k = len(text) // 4
    return text[:len(text) - k] + other[:k]


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
RUN = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                 ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                 ("part", pa.int64()), ("is_first", pa.bool_()), ("text", pa.string())])
RUN_SCHEMA = f"{RESULT}, part bigint, is_first boolean, text string"


def _compared(doc_id, text: str, own: bytes, after: str, after_print: bytes) -> tuple:
    edited = with_foreign_tail(text, after)
    edited_print = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, edited_print,
            likeness(own, edited_print), likeness(own, after_print))


def _along(batches):
    """Every row of a sorted partition beside the next; the first and last rows keep their texts for the partitions around."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    held = None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = fingerprint(text)
            if held is None:
                rows.append((doc_id, None, None, own, None, None, None, part, True, text))
            else:
                rows.append((*_compared(*held, text, own), part, False, None))
            held = doc_id, text, own
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RUN, strict=True)], schema=RUN)
    if held is not None:
        row = (held[0], None, None, held[2], None, None, None, part, False, held[1])
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, RUN, strict=True)], schema=RUN)


def _across(batches):
    """The last row of a partition beside the first of the next one."""
    for batch in batches:
        rows = [_compared(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_print"]) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], RUN.field(i).type) for i in range(7)], schema=pa.schema(list(RUN)[:7]))


def fingerprints(documents: DataFrame) -> DataFrame:
    """The digest of every whole text, and how near it is to its edited text and to the next document.

    One row per row of ``documents``, in which only ``doc_id`` and ``text`` are
    read.  The next document is that of the next id, after the last one the
    first; a single row is its own next.  A null text is empty, an empty text
    has a digest like any other.  A null id stays null and comes first.  Rows
    of one id follow each other by the hash of their texts, equal rows in any
    order, so a repeated id may spread over partitions.  Texts may be of any
    length: triplets are counted slice by slice.

    Texts are shuffled once, into ranges of ids; neighbours meet in one sorted
    pass, and only the first and last row of each partition is joined again.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = texts.select("*", *[c.alias(f"k{i}") for i, c in enumerate(order[1:])])
    ordered = keyed.repartitionByRange("doc_id", "k0", "k1").sortWithinPartitions("doc_id", "k0", "k1").select("doc_id", "text")
    runs = written(ordered.mapInArrow(_along, RUN_SCHEMA), "fingerprints")
    edges = runs.where("text IS NOT NULL")
    # one row of numbers for each partition
    parts = edges.where("is_first").select("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    heads = edges.where("is_first").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    last = edges.where("NOT is_first").join(after, "part").join(heads, "next_part").select("doc_id", "text", "fingerprint", "next_text", "next_print")
    inner = runs.where("near_next IS NOT NULL").select(*[f.name for f in list(RUN)[:7]])
    return inner.unionByName(last.mapInArrow(_across, RESULT))


def _hex(column: str) -> Column:
    return F.lower(F.hex(column)).alias(column)


def fingerprint_digest(documents: DataFrame) -> DataFrame:
    """``fingerprints`` with the digests as lowercase hexadecimal text; rows and odd cases as there."""
    return fingerprints(documents).select("doc_id", "n_chars", "edited_sha256", _hex("fingerprint"), _hex("edited_fingerprint"), "near_edited", "near_next")
