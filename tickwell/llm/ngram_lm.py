"""Language-model scores from an n-gram trie in Elias-Fano coding.

The model is a bigram model with a Dirichlet prior::

    p(w | v) = (c(v w) + k (c(w) + 0.1)) / (c(v) + k (N + 0.1 (V + 1))),  k = PRIOR / N

It is proper, covers unknown words, and its logarithm splits into one term of
the word (with its predecessor) and one of the predecessor alone.  So the trie
can be cut into shards by word: every token meets, in the shard of its word,
all counts that its terms need, and a document's score is a sum over shards.
One exchange carries the training counts and the queries together.

A shard's trie has the words on its first level and, below each word, the
predecessors it was seen after.  Both levels and the pointers between them are
monotone sequences in Elias-Fano coding; terms are logarithms in 16 bits.  The
levels stand one behind the other in a file of the task, which is mapped into
memory and goes with the task.  A predecessor is kept relative to its word: the
level is monotone because every word's predecessors start at a base of their
own, and a predecessor is found by successor search between the two pointers of
its word.
"""

from __future__ import annotations

import math
import tempfile
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.frames import as_ids, fold, whole_numbers, written

PRIOR = 100.0
SHARD_TOKENS = 3_000_000  # tokens of one shard
BLOCK_TOKENS = 1_500_000  # tokens of one block of documents, about; a longer text is a block of its own
LISTED = 1_000_000  # frequent words that are dealt by predecessor, at most
END, BEGIN = np.uint64(1), np.uint64(2)
ONE = np.uint64(1)


# --- Elias-Fano --------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: low bits packed, high bits in unary.

    ``select`` and the successor search use counts per 64-bit word of the unary
    part.  Everything is an array over one buffer, so ``load`` copies nothing.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        mask = np.uint64((1 << bits) - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if n and bits:
            part, word, off = values & mask, (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low[word[starts]] |= np.bitwise_or.reduceat(part << off, starts)
            over = off + np.uint64(bits) > np.uint64(64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - off[over])
        ones_at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = int(ones_at[-1]) + 1 if n else 0
        plain = np.zeros((size // 64 + 2) * 64, np.uint8)
        plain[ones_at] = 1
        high = np.packbits(plain, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(np.bitwise_count(high).astype(np.int64))]
        return cls(n, bits, low, high, ones[:-1])

    def dump(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.int64).view(np.uint64), self.low, self.high, self.ones.view(np.uint64)]

    @classmethod
    def load(cls, buffer: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, bits, low, high = buffer[at:at + 4].view(np.int64).tolist()
        at += 4
        parts = []
        for size in (low, high, high):
            parts.append(buffer[at:at + size])
            at += size
        return cls(n, bits, parts[0], parts[1], parts[2].view(np.int64)), at

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        high = self._select(self.ones, self.high, i) - i
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(i)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> off
        over = off + np.uint64(self.low_bits) > np.uint64(64)
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - off[over])
        return value & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _select(counts: np.ndarray, words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Positions of the set bits with the given ranks."""
        word = np.searchsorted(counts, rank, side="right") - 1
        left = (rank - counts[word]).astype(np.int64)
        bits = words[word].copy()
        at = np.zeros(len(rank), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            lower = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= lower
            left -= np.where(go, lower, 0)
            at += np.where(go, width, 0)
            bits = np.where(go, bits >> np.uint64(width), bits)
        return word * 64 + at

    def successor(self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Position of the first element not below each value, among those from ``first`` to before ``last``; ``last`` when there is none."""
        values = values.astype(np.uint64)
        high = np.minimum(values >> np.uint64(self.low_bits), np.uint64(1 << 62)).astype(np.int64)
        last = self.n if last is None else last
        at = np.clip(self._before(high), first, last)
        end = np.clip(self._before(high + 1), first, last)
        # Elements of one high part are ordered by their low bits.
        low = values & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + end[open_]) // 2
            less = self._lows(middle) < low[open_]
            at[open_] = np.where(less, middle + 1, at[open_])
            end[open_] = np.where(less, end[open_], middle)
            open_ = open_[at[open_] < end[open_]]
        return at

    def _before(self, high: np.ndarray) -> np.ndarray:
        """Number of elements whose high part is smaller: they stand before the zero that closes it."""
        zeros = len(self.high) * 64 - self.n
        inside = np.flatnonzero((high > 0) & (high <= zeros))
        out = np.where(high > 0, self.n, 0)
        out[inside] = self._select(self.zeros, ~self.high, high[inside] - 1) - (high[inside] - 1)
        return out


class Codes:
    """Logarithms in 16 bits between the smallest and the largest."""

    def __init__(self, low: float, step: float, codes: np.ndarray):
        self.low, self.step, self.codes = low, step, codes

    @classmethod
    def encode(cls, logs: np.ndarray) -> Codes:
        low = float(logs.min(initial=0.0))
        step = (float(logs.max(initial=0.0)) - low) / 65_535 or 1.0
        return cls(low, step, np.rint((logs - low) / step).astype(np.uint16))

    def dump(self) -> list[np.ndarray]:
        padded = np.pad(self.codes, (0, -len(self.codes) % 4)).view(np.uint64)
        return [np.array([self.low, self.step]).view(np.uint64), np.array([len(self.codes)], np.uint64), padded]

    @classmethod
    def load(cls, buffer: np.ndarray, at: int) -> tuple[Codes, int]:
        low, step = buffer[at:at + 2].view(np.float64).tolist()
        n = int(buffer[at + 2])
        end = at + 3 + -(-n // 4)
        return cls(low, step, buffer[at + 3:end].view(np.uint16)[:n]), end

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return self.low + self.step * self.codes[i]


class Trie:
    """Words, pointers and predecessors of one shard with the terms of the model."""

    def __init__(self, words: EliasFano, pointers: EliasFano, before: EliasFano, joint: Codes, alone: Codes, context: Codes, unknown: tuple[float, float]):
        self.words, self.pointers, self.before = words, pointers, before
        self.joint, self.alone, self.context, self.unknown = joint, alone, context, unknown

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, owner: np.ndarray, before: np.ndarray, pairs: np.ndarray, total: int, distinct: int) -> Trie:
        """``words`` sorted with their counts; ``(owner, before)`` sorted pairs of word number and predecessor with theirs."""
        k = PRIOR / max(total, 1)
        mass = k * (total + 0.1 * (distinct + 1))
        pointers = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(words)))]
        keys = (owner.astype(np.uint64) << np.uint64(32)) | before.astype(np.uint64)
        return cls(EliasFano.encode(words), EliasFano.encode(pointers), EliasFano.encode(keys),
                   Codes.encode(np.log10(pairs + k * (counts[owner] + 0.1))), Codes.encode(np.log10(k * (counts + 0.1))),
                   Codes.encode(np.log10(counts + mass)), (math.log10(k * 0.1), math.log10(mass)))

    def write(self, file) -> None:
        """All levels, one behind the other."""
        np.array(self.unknown).tofile(file)
        for level in (self.words, self.pointers, self.before, self.joint, self.alone, self.context):
            for part in level.dump():
                part.tofile(file)

    def mapped(self) -> Trie:
        """The same trie over a file, whose name is gone at once and whose space is freed with the mapping."""
        with tempfile.NamedTemporaryFile(prefix="trie-") as file:
            self.write(file)
            file.flush()
            return Trie.open(file.name)

    @classmethod
    def open(cls, source) -> Trie:
        """A trie over a buffer, or over a file that is mapped into memory."""
        data = np.asarray(np.memmap(source, np.uint64, "r")) if isinstance(source, str) else np.frombuffer(source, np.uint64)
        unknown = tuple(data[:2].view(np.float64).tolist())
        at, levels = 2, []
        for kind in (EliasFano, EliasFano, EliasFano, Codes, Codes, Codes):
            level, at = kind.load(data, at)
            levels.append(level)
        return cls(*levels, unknown)

    def lookup(self, words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the numerator, log10 of the word's own denominator as a predecessor) of word and predecessor."""
        n = self.words.n
        numerator, denominator = np.full(len(words), self.unknown[0]), np.full(len(words), self.unknown[1])
        if not n or not len(words):
            return numerator, denominator
        # A run of one word is searched once.
        change = np.r_[True, words[1:] != words[:-1]]
        asked = words[change]
        place = np.minimum(self.words.successor(asked), n - 1)
        place[self.words[place] != asked] = -1
        first, limit = self.pointers[np.maximum(place, 0)].astype(np.int64), self.pointers[place + 1].astype(np.int64)
        run = np.cumsum(change) - 1
        known = np.flatnonzero(place[run] >= 0)
        run = run[known]
        at = place[run]
        denominator[known] = self.context[place][run]
        numerator[known] = self.alone[place][run]
        if self.before.n:
            keys = (at.astype(np.uint64) << np.uint64(32)) | before[known].astype(np.uint64)
            child = self.before.successor(keys, first[run], limit[run])
            inside = child < limit[run]
            child = np.minimum(child, self.before.n - 1)
            seen = np.flatnonzero(inside & (self.before[child] == keys))
            numerator[known[seen]] = self.joint[child[seen]]
        return numerator, denominator


# --- tokens ------------------------------------------------------------------------


def hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, then the end token."""
    import xxhash
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    out[-1] = END
    return out


def _counts(batches):
    """Training tokens of a batch, each once with its count."""
    for batch in batches:
        texts = batch["text"][batch["train"]]
        if len(texts):
            word, count = np.unique(np.concatenate([hashes(t) for t in texts]), return_counts=True)
            yield pd.DataFrame({"word": word.view(np.int64), "n": count})


def _blocks(batches):
    """Batches cut so that a block has about ``BLOCK_TOKENS``; yields rows and their token hashes."""
    for batch in batches:
        lists, size, first = [], 0, 0
        for i, text in enumerate(batch["text"]):
            lists.append(hashes(text))
            size += len(lists[-1])
            if size >= BLOCK_TOKENS or i == len(batch) - 1:
                yield batch.iloc[first:i + 1][["doc_id", "train"]], lists
                lists, size, first = [], 0, i + 1


def _before(word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The predecessor of every token of texts that follow each other."""
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


def _place(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value among the sorted ``known``, -1 where it is not there."""
    if not len(known):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def _pair_counts(frequent: np.ndarray, batches):
    """Training pairs of frequent words, each once a block with its count; the beginning counts as a frequent predecessor."""
    ahead = np.sort(np.append(frequent, BEGIN))
    for batch, lists in _blocks(batches):
        lists = [x for x, train in zip(lists, batch["train"], strict=True) if train]
        if lists:
            word, sizes = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
            second, first = _place(frequent, word), _place(ahead, _before(word, sizes))
            both = (second >= 0) & (first >= 0)
            pair, count = np.unique(first[both] * len(frequent) + second[both], return_counts=True)
            yield pd.DataFrame({"pair": pair, "n": count})


@dataclass(frozen=True)
class Common:
    """Words and pairs that are counted beforehand, with the totals of the model; bounded lists."""

    words: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray  # predecessor's place among ``ahead`` times the number of words, plus the word's place
    pair_counts: np.ndarray
    total: int
    distinct: int

    @property
    def ahead(self) -> np.ndarray:
        return np.sort(np.append(self.words, BEGIN))

    def hot(self, word: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Place of each token's pair among the common pairs, -1 for others."""
        if not len(self.pairs):
            return np.full(len(word), -1, np.int64)
        second, first = _place(self.words, word), _place(self.ahead, before)
        return np.where((second >= 0) & (first >= 0), _place(self.pairs, first * len(self.words) + second), -1)

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """(base, gain) of a token of each common pair, as a shard would give them."""
        second = self.pairs % max(len(self.words), 1)
        count, k = self.counts[second], PRIOR / max(self.total, 1)
        after = np.where(self.words[second] == END, 0.0, np.log10(count + k * (self.total + 0.1 * (self.distinct + 1))))
        return np.log10(count + 0.1), np.log10(self.pair_counts + k * (count + 0.1)) - after


def _deal(shards: int, common: Common, batches):
    """Tokens of a block of documents by shard: words with run lengths, predecessors, documents.

    Tokens of common pairs stay: the block adds their terms itself, so no shard
    gets all of a pair that very many documents have.
    """
    from pyspark import TaskContext
    part, frequent = TaskContext.get().partitionId(), common.words
    base_of, gain_of = common.terms()
    for number, (batch, lists) in enumerate(_blocks(batches)):
        sizes = np.array([len(x) for x in lists], np.int64)
        word = np.concatenate(lists)
        lists.clear()
        before = _before(word, sizes)
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint16 if len(sizes) <= 65_535 else np.uint32), sizes)
        hot = common.hot(word, before)
        own, at = np.unique(doc[hot >= 0], return_inverse=True)
        hot, rest = hot[hot >= 0], hot < 0
        kept = (own.astype(np.uint32).tobytes(), np.bincount(at, base_of[hot], len(own)).tobytes(), np.bincount(at, gain_of[hot], len(own)).tobytes(),
                np.bincount(at, minlength=len(own)).astype(np.uint32).tobytes())
        word, before, doc = word[rest], before[rest], doc[rest]
        key = word.copy()
        if len(frequent):
            often = frequent[np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)] == word
            key[often] ^= before[often] * np.uint64(0x9E3779B97F4A7C15)
        shard = ((key * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)) % np.uint64(shards)
        shard = shard.astype(np.uint16 if shards < 65_536 else np.int64)
        del key
        before = (before >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(shard, kind="stable")
        bounds = np.r_[0, np.cumsum(np.bincount(shard, minlength=shards))]
        ids = whole_numbers(as_ids(batch["doc_id"]))
        head = np.concatenate([ids.to_numpy(np.int64, na_value=0), ids.isna().astype(np.int64), sizes, batch["train"].to_numpy(np.int64)]).tobytes()
        train = batch["train"].to_numpy(bool)
        rows = []
        for s in np.flatnonzero(np.diff(bounds)) if len(word) else [0]:  # the head needs a row
            mine = order[bounds[s]:bounds[s + 1]]
            mine = mine[np.argsort(word[mine], kind="stable")]
            own, runs = np.unique(word[mine], return_counts=True)
            there, place = np.unique(doc[mine], return_inverse=True)
            rows.append((int(s), (part << 24) + number, head, len(sizes), np.packbits(train[there]).tobytes(), own.tobytes(), runs.astype(np.uint32).tobytes(),
                         before[mine].tobytes(), place.astype(doc.dtype).tobytes(), there.tobytes(), *(kept if len(head) else [b""] * 4)))
            head = b""
        yield pd.DataFrame(rows, columns=["shard", "block", "head", "docs", "train", "words", "runs", "before", "place", "doc", *KEPT])


# Documents that occur in a row, whether they are training texts, and for each token the place of its document among them.
# The first row of a block also brings its sums over common pairs.
KEPT = ["kept_doc", "kept_base", "kept_gain", "kept_known"]
DEALT = "shard int, block long, head binary, docs int, train binary, words binary, runs binary, before binary, place binary, doc binary, " + ", ".join(f"{c} binary" for c in KEPT)


SCORED = ["block", "head", "docs", "doc", "base", "gain", "known"]


def _score(common: Common, rows: pd.DataFrame) -> pd.DataFrame:
    """Build the trie of one shard and sum its terms per block and document."""
    frequent, frequent_counts, total, distinct = common.words, common.counts, common.total, common.distinct
    out = [(block, b"", n, *kept) for block, n, *kept in zip(rows["block"], rows["docs"], *(rows[c] for c in KEPT), strict=True) if len(kept[0])]
    bare = [len(w) == 0 for w in rows["words"]]  # heads of blocks that have only common pairs
    out += [(block, head, n, b"", b"", b"", b"") for block, head, n, none in zip(rows["block"], rows["head"], rows["docs"], bare, strict=True) if none]
    rows = rows[~np.array(bare, bool)].reset_index(drop=True)
    if not len(rows):
        return pd.DataFrame(out, columns=SCORED)
    narrow = [np.uint16 if n <= 65_535 else np.uint32 for n in rows["docs"]]
    lists = [np.frombuffer(w, np.uint64) for w in rows["words"]]
    vocabulary = np.unique(np.concatenate(lists))
    number = np.concatenate([np.repeat(np.searchsorted(vocabulary, w).astype(np.uint64), np.frombuffer(r, np.uint32)) for w, r in zip(lists, rows["runs"], strict=True)])
    keys = (number << np.uint64(32)) | np.concatenate([np.frombuffer(b, np.uint32) for b in rows["before"]])
    del number
    place, doc = ([np.frombuffer(d, kind) for d, kind in zip(rows[c], narrow, strict=True)] for c in ("place", "doc"))
    blocks = rows[["block", "head", "docs"]]
    train = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(d))[p] for t, d, p in zip(rows["train"], doc, place, strict=True)])
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    pairs = np.add.reduceat(train[order].astype(np.int32), new).astype(np.int64)
    group = np.empty(len(keys), np.int32)
    group[order] = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(np.r_[new, len(keys)]))
    del order, train, rows
    keys = keys[new]
    owner, before = (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF)
    counts = np.bincount(owner, pairs, len(vocabulary)).astype(np.int64)
    if len(frequent):  # counts of all shards
        at = np.minimum(np.searchsorted(frequent, vocabulary), len(frequent) - 1)
        counts = np.where(frequent[at] == vocabulary, frequent_counts[at], counts)
    have, seen = counts > 0, pairs > 0
    rank = np.cumsum(have) - 1
    trie = Trie.build(vocabulary[have], counts[have], rank[owner[seen]], before[seen], pairs[seen], total, distinct).mapped()
    # Every word is looked up once with each predecessor.
    numerator, denominator = trie.lookup(vocabulary[owner], before)
    denominator[vocabulary[owner] == END] = 0.0  # nothing follows the end
    base, gain, known = np.log10(counts + 0.1)[owner], numerator - denominator, have[owner]
    start = 0
    for block, head, n, d, p in zip(blocks["block"], blocks["head"], blocks["docs"], doc, place, strict=True):
        end = start + len(p)
        mine = group[start:end]
        out.append((block, head, n, d.astype(np.uint32).tobytes(), np.bincount(p, base[mine], len(d)).tobytes(),
                    np.bincount(p, gain[mine], len(d)).tobytes(), np.bincount(p, known[mine], len(d)).astype(np.uint32).tobytes()))
        start = end
    return pd.DataFrame(out, columns=SCORED)


def _gather(total: int, distinct: int, training_docs: int, rows: pd.DataFrame) -> pd.DataFrame:
    n = int(rows["docs"].iloc[0])
    base, gain, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for doc, b, g, k in zip(rows["doc"], rows["base"], rows["gain"], rows["known"], strict=True):
        at = np.frombuffer(doc, np.uint32)
        base[at] += np.frombuffer(b, np.float64)
        gain[at] += np.frombuffer(g, np.float64)
        known[at] += np.frombuffer(k, np.uint32)
    head = np.frombuffer(next(h for h in rows["head"] if len(h)), np.int64)
    ids, missing, sizes, train = head.reshape(4, n)
    k = PRIOR / max(total, 1)
    first = math.log10(training_docs + k * (total + 0.1 * (distinct + 1)))
    return pd.DataFrame({
        "doc_id": pd.arrays.IntegerArray(ids.copy(), missing.astype(bool)),
        "held_out": train == 0, "n_tokens": sizes, "n_known": known, "train_tokens": total,
        "base_score": base - sizes * math.log10(total + 0.1 * (distinct + 1)), "score": gain - first})


def text_scores(documents: DataFrame, held_out: int = 0, folds: int = 10, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from all documents outside the held-out fold and scores all.  A null
    text is empty and has its end token; a null id counts as remainder 0;
    repeated rows are learned and scored each.  Without training texts every
    word is unknown.  An empty table gives an empty result.
    """
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                            (fold("doc_id", folds) != held_out).alias("train"))
    vocabulary = written(rows.mapInPandas(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct, training_docs = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == int(END), F.col("n"))), F.lit(0))).first()
    # At most total / limit <= LISTED words pass, so this list has a fixed bound.
    limit = max(shard_tokens // 8, math.ceil(total / LISTED))
    often = vocabulary.where(F.col("n") >= limit).toPandas()
    words = often["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    frequent, counts = words[order], often["n"].to_numpy(np.int64)[order]
    pairs = pd.DataFrame({"pair": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    if len(frequent):  # as many pairs at most, for the same reason
        pairs = rows.mapInPandas(partial(_pair_counts, frequent), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where(
            F.col("n") >= limit).toPandas().sort_values("pair")
    common = Common(frequent, counts, pairs["pair"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64), total, distinct)
    shards = max(1, math.ceil(total * folds / max(folds - 1, 1) / shard_tokens))
    dealt = rows.mapInPandas(partial(_deal, shards, common), DEALT)
    scored = dealt.groupBy("shard").applyInPandas(
        partial(_score, common), "block long, head binary, docs int, doc binary, base binary, gain binary, known binary")
    return scored.groupBy("block").applyInPandas(
        partial(_gather, total, distinct, training_docs),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
