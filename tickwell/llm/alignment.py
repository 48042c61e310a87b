"""Alignment of two tokenizations of the same texts, by interval coalescing.

The tokens of both vocabularies are byte intervals of a text.  They are sorted
by start; where a start reaches the running maximum of the ends before it, a
group ends and the next begins.  Inside a group every token is linked with the
tokens of the other side that its bytes overlap.

Counts of linked ids go over the whole corpus.  A task writes its documents in
blocks of a bounded number of tokens, each with the distinct id pairs of the
block; only these are exchanged, summed, ranked and sent back to their block.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.frames import written

B_BITS = 20  # a pair of ids is one number; vocabularies must be smaller than 2 to this power
SLICE_BYTES = 2_000_000  # text that is aligned at a time, at least one document
BLOCK_LINKS = 4_000_000  # links after which a block of documents is closed


@dataclass
class Side:
    """One vocabulary: texts to ids, and the bytes of every id."""

    encode: Callable[[list[str]], list[np.ndarray]]
    token_bytes: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(t) for t in self.token_bytes], np.int64)

    def ids_of(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text, None where their bytes are not a space and the text."""
        found = self.encode(texts)
        return [ids if b"".join(map(self.token_bytes.__getitem__, ids.tolist())) == b" " + text.encode() else None
                for ids, text in zip(found, texts, strict=True)]


def load_pair() -> tuple[Side, Side]:
    """The public byte-level vocabulary of 50,257 ids, and the public pieces with byte fallback.

    The rank file of the first gives the ids of its ``.json`` without special
    tokens, several times faster; the tests compare both.
    """
    import public_tokenizers
    import sentencepiece
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece_bytes(i: int) -> bytes:
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    a = Side(lambda texts: [coder.encode_to_numpy(" " + t) for t in texts], sorted(ranks, key=ranks.get))
    b = Side(lambda texts: [np.array(ids, np.int64) for ids in pieces.encode(texts, num_threads=1)],
             [piece_bytes(i) for i in range(pieces.get_piece_size())])
    return a, b


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the tokens of both sides, given their byte lengths over the same bytes."""
    ends = np.concatenate([np.cumsum(a), np.cumsum(b)])
    starts = ends - np.concatenate([a, b])
    order = np.lexsort((np.arange(len(ends)) >= len(a), starts))
    reach = np.maximum.accumulate(ends[order])
    number = np.empty(len(ends), np.int64)
    number[order] = np.cumsum(np.r_[0, starts[order][1:] >= reach[:-1]]) if len(ends) else 0
    return number[:len(a)], number[len(a):]


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of every overlapping pair, given the byte lengths of both sides."""
    end_a, end_b = np.cumsum(a), np.cumsum(b)
    first = np.searchsorted(end_b, end_a - a, "right")
    many = np.searchsorted(end_b - b, end_a, "left") - first
    left = np.repeat(np.arange(len(a)), many)
    return left, np.arange(len(left)) + np.repeat(first - (np.cumsum(many) - many), many)


class Aligner:
    """Aligns texts of a task with one pair of vocabularies."""

    def __init__(self, pair: tuple[Side, Side]):
        self.a, self.b = pair
        self.size = max(len(self.a.token_bytes), len(self.b.token_bytes))
        if self.size >= 1 << B_BITS:
            raise ValueError("vocabulary too large")
        self.shown = np.array([b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(self.size)], object)

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups text in bytes, distinct pairs, their counts) of each text."""
        both = [(x, y) if t and x is not None and y is not None else (np.zeros(0, np.int64),) * 2
                for t, x, y in zip(texts, self.a.ids_of(texts), self.b.ids_of(texts), strict=True)]
        ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *side]).astype(np.int64) for side in zip(*both, strict=True))
        stop_a, stop_b = (np.cumsum([len(p[k]) for p in both]) for k in (0, 1))
        len_a, len_b = self.a.lengths[ids_a], self.b.lengths[ids_b]
        group_a, group_b = groups(len_a, len_b)
        # written form: both sides of a group after each other
        group, side = np.concatenate([group_a, group_b]), np.arange(len(ids_a) + len(ids_b)) >= len(ids_a)
        order = np.lexsort((side, group))
        last = np.r_[np.diff(2 * group[order] + side[order]) != 0, True][:len(order)]
        shown = self.shown[np.concatenate([ids_a, ids_b])[order] + self.size * (last * (1 + side[order]))]
        # distinct pairs of each document
        left, right = links(len_a, len_b)
        document = np.searchsorted(stop_a, left, "right")
        keys = np.sort((document << 2 * B_BITS) | (ids_a[left] << B_BITS) | ids_b[right])
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        counts = np.diff(np.r_[at, len(keys)])
        keys = keys[at]
        bounds = np.searchsorted(keys >> 2 * B_BITS, np.arange(len(texts) + 1), "left")
        pairs = keys & ((1 << 2 * B_BITS) - 1)
        out = []
        for k, (x, y) in enumerate(both):
            p, q = bounds[k], bounds[k + 1]
            if not len(x):
                out.append((0, 0, 0, 0, b"", pairs[p:q], counts[p:q]))
                continue
            to_a, to_b = stop_a[k], stop_b[k]
            text = b"".join(shown[to_a + to_b - len(x) - len(y):to_a + to_b].tolist())[:-1]
            out.append((len(x), len(y), int(group_a[to_a - 1] - group_a[to_a - len(x)] + 1), int(counts[p:q].sum()), text, pairs[p:q], counts[p:q]))
        return out


DOC_LISTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "distinct")
BLOCK = pa.schema([("block", pa.int64()), *[(c, pa.list_(pa.int64())) for c in DOC_LISTS], ("groups_sha256", pa.list_(pa.string())),
                   ("links", pa.binary()), ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])
BLOCK_SCHEMA = ("block bigint, " + ", ".join(f"{c} array<bigint>" for c in DOC_LISTS)
                + ", groups_sha256 array<string>, links binary, pair array<bigint>, n array<bigint>")


def _packed(values: np.ndarray) -> bytes:
    """Non-negative numbers below 2**32, the bytes of each place together, compressed."""
    import zstandard
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def _block(number: int, docs: list[tuple]) -> pa.RecordBatch:
    """One row: documents (id, n_a, n_b, n_groups, n_links, sha, pairs, counts), and the distinct pairs of all of them."""
    pairs, counts = (np.concatenate([d[k] for d in docs]) for k in (6, 7))
    distinct, place = np.unique(pairs, return_inverse=True)
    total = np.bincount(place, counts, len(distinct)).astype(np.int64)  # exact: far below 2**53
    sizes = np.array([len(d[6]) for d in docs])
    starts = np.cumsum(sizes) - sizes
    steps = np.diff(place, prepend=0)
    steps[starts[sizes > 0]] = place[starts[sizes > 0]]  # rising inside each document
    lists = [[d[k] for d in docs] for k in range(5)] + [sizes.tolist(), [d[5] for d in docs]]
    row = [number, *lists, _packed(np.concatenate([steps, counts])), distinct, total]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK, strict=True)], schema=BLOCK)


def aligned_blocks(documents: DataFrame, load=load_pair, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Blocks of aligned documents as in ``BLOCK_SCHEMA``."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        aligner = Aligner(load())
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            at = 0
            while at < len(ids):
                slice_, taken = [], 0
                while at + len(slice_) < len(ids) and taken < SLICE_BYTES:
                    slice_.append(texts[at + len(slice_)].as_py() or "")
                    taken += len(slice_[-1])
                for doc, (n_a, n_b, n_groups, n_links, text, pairs, counts) in zip(ids[at:at + len(slice_)], aligner.align(slice_), strict=True):
                    held.append((doc, n_a, n_b, n_groups, n_links, hashlib.sha256(text).hexdigest() if n_a else "", pairs, counts))
                    size += n_links
                    if size >= block_links:
                        yield _block(number, held)
                        number, held, size = number + 1, [], 0
                at += len(slice_)
        if held:
            yield _block(number, held)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCK_SCHEMA)


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _scored(blocks: pa.Table, totals: pa.Table) -> pa.Table:
    """Documents of one block with the corpus counts of its pairs."""
    order = np.argsort(totals["pair"].to_numpy())
    total, best = (totals[c].to_numpy()[order] for c in ("total", "best"))
    row = blocks.to_pylist()[0]
    steps, counts = np.split(_unpacked(row["links"]), 2)
    sizes = np.array(row["distinct"], np.int64)
    stops = np.cumsum(sizes)
    place = np.cumsum(steps)
    before = np.r_[0, place][stops - sizes]
    place -= np.repeat(before, sizes)

    def summed(values):
        return np.diff(np.r_[0, np.r_[0, np.cumsum(values)][stops]])
    out = [pa.array(row[c], pa.int64()) for c in DOC_LISTS[:5]]
    out += [pa.array(summed(counts * best[place])), pa.array(summed(counts * total[place])), pa.array(row["groups_sha256"], pa.string())]
    return pa.table(out, names=[c.split()[0] for c in RESULT.split(", ")])


def alignment_digest(documents: DataFrame, load=load_pair, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per row of ``documents``: its tokens, groups and links, and how common its links are in the corpus.

    Only ``doc_id`` and ``text`` are read.  A text that is null or empty, or
    whose tokens do not give back its bytes on either side, has no tokens and
    zeros.  A null id stays null; repeated rows count each; an empty table
    gives no rows.  A text is aligned whole, in memory in proportion to its
    length; shorter ones together, slice by slice.

    The highest count of each id of the second vocabulary, one row an id, is
    sent to all executors: that is bounded by the vocabulary.
    """
    blocks = written(aligned_blocks(documents, load, block_links), "aligned", compression="zstd")
    pairs = blocks.select("block", F.explode(F.arrays_zip("pair", "n")).alias("p")).select("block", "p.*")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    ranked = totals.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).cast("bigint").alias("best"))
    back = pairs.select(F.col("block").alias("of"), "pair").join(ranked, "pair")
    return blocks.drop("pair", "n").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_scored, RESULT)
