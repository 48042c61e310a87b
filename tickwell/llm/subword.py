"""Hashed character n-grams of words, and the small embedding models trained on them with numpy.

A word is the mean of the vectors of its n-grams (``<`` and ``>`` mark its
ends), so a misspelling shares most of its vector with the word it came from.
Two classifiers stand on it: a bag of all words for languages, and single
words joined by noisy-or for traits that one word can give to a text.
"""

from __future__ import annotations

import io

import numpy as np

BUCKETS = 1 << 16
SIZES = (3, 4, 5)
PIECE = 64  # characters; longer runs without a space are read as overlapping pieces
LEAST = 1e-9  # probability of a word, at least; at most 1 less this
EDGE = ".,;:!?\"'()[]{}<>*_-"


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def pieces(word: str) -> list[str]:
    """The word without punctuation at its ends, cut into overlapping pieces when it is very long."""
    word = word.strip(EDGE) or word
    if len(word) <= PIECE:
        return [word]
    return [word[i:i + PIECE] for i in range(0, len(word) - max(SIZES), PIECE - max(SIZES))]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of every word, in no particular order."""
    coded = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(coded), dtype=np.int64), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(data))  # bytes to the end of the word
    found, owners = [], []
    rolling = data + np.uint32(0x811C)
    for n in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) ^ data[n - 1:]
        if n in SIZES:
            ok = left[:len(rolling)] >= n
            mixed = rolling[ok] * np.uint32(0x9E3779B1)
            found.append(((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64))
            owners.append(owner[:len(rolling)][ok])
    return np.concatenate(found), np.concatenate(owners)


class Model:
    """Embedding per bucket, linear softmax above it, and scalars that a task adds."""

    def __init__(self, classes: list[str], embedding: np.ndarray, weight: np.ndarray, bias: np.ndarray, **scalars: float):
        self.classes, self.embedding, self.weight, self.bias, self.scalars = classes, embedding, weight, bias, scalars

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, classes=np.array(self.classes, dtype="U"), embedding=self.embedding.astype(np.float32),
                            weight=self.weight, bias=self.bias, names=np.array(list(self.scalars), dtype="U"),
                            values=np.array(list(self.scalars.values()), dtype=float))
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Model:
        x = np.load(io.BytesIO(blob))
        scalars = dict(zip(x["names"].tolist(), x["values"].tolist(), strict=True))
        return cls(x["classes"].tolist(), x["embedding"], x["weight"], x["bias"], **scalars)

    def table(self) -> np.ndarray:
        """Class scores per bucket: the embedding seen through the linear layer."""
        return (self.embedding @ self.weight.T).astype(np.float64)


class WordScores:
    """Class scores of single words before the bias; words that came before are looked up."""

    LIMIT = 200_000  # words kept, about 40 MB; the cache starts anew beyond
    TEXTS = 256  # texts whose words are held at once

    def __init__(self, model: Model, reduce: str = "mean"):
        self.table, self.reduce = model.table(), reduce
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, self.table.shape[1]))

    def add(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > self.LIMIT:
            self.known, self.scores, new = {}, self.scores[:0], list(words)
        parts = [[w] for w in new] if self.reduce == "pieces" else [pieces(w) for w in new]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        scored = gram_means([p for ps in parts for p in ps], self.table)
        starts = np.cumsum(counts) - counts
        if self.reduce == "pieces":  # the caller has cut the words; odds of class 1
            odds = scored[:, 1] - scored[:, 0]
            scored = np.stack([np.zeros_like(odds), odds], axis=1)
        else:
            scored = np.add.reduceat(scored, starts, axis=0) / counts[:, None]
        self.known.update(zip(new, range(len(self.scores), len(self.scores) + len(new)), strict=True))
        self.scores = np.vstack([self.scores, scored])


def gram_means(words: list[str], table: np.ndarray) -> np.ndarray:
    """Mean row of ``table`` over the n-grams of each word, in blocks of bounded size."""
    out = np.empty((len(words), table.shape[1]))
    for lo in range(0, len(words), 50_000):
        block = words[lo:lo + 50_000]
        bucket, owner = grams(block)
        counts = np.bincount(owner, minlength=len(block))
        for k in range(table.shape[1]):
            out[lo:lo + len(block), k] = np.bincount(owner, table[bucket, k], len(block)) / np.maximum(counts, 1)
    return out


class Adam:
    """Adam for one array."""

    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.m, self.v, self.t = value, rate, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        self.value -= rate * self.m / (np.sqrt(self.v) + 1e-8)


class Trainer:
    """Embedding and softmax trained together; a step takes word lists and gives word vectors' gradients back."""

    BLOCK = 5_000  # words whose n-grams are held at once, so a very long text needs no more memory

    def __init__(self, vocabulary: list[str], classes: int, dim: int, seed: int, rate: float):
        rng = np.random.default_rng(seed)
        bucket, owner = grams(vocabulary) if vocabulary else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(owner, kind="stable")
        self.bucket, self.counts = bucket[order], np.bincount(owner, minlength=len(vocabulary))
        self.starts = np.cumsum(self.counts) - self.counts
        self.embedding = Adam(rng.normal(0, 0.5 / np.sqrt(dim), (BUCKETS, dim)), rate)
        self.weight = Adam(rng.normal(0, 0.5, (classes, dim)), rate)
        self.bias = Adam(np.zeros(classes), rate)

    def blocks(self, words: np.ndarray):
        """(first word, bucket and word of every n-gram, n-grams of each word) of at most ``BLOCK`` words at a time."""
        for lo in range(0, len(words), self.BLOCK):
            part = words[lo:lo + self.BLOCK]
            counts = self.counts[part]
            ends = np.cumsum(counts)
            where = np.arange(counts.sum()) - np.repeat(ends - counts, counts) + np.repeat(self.starts[part], counts)
            yield lo, self.bucket[where], np.repeat(np.arange(len(part)), counts), counts

    def forward(self, words: np.ndarray):
        """Vectors of the given words of the vocabulary, and what ``backward`` needs."""
        vectors = np.empty((len(words), self.embedding.value.shape[1]))
        for lo, bucket, _, counts in self.blocks(words):
            summed = np.add.reduceat(self.embedding.value[bucket], np.cumsum(counts) - counts, axis=0)
            vectors[lo:lo + len(counts)] = summed / counts[:, None]
        return vectors, words

    def backward(self, words: np.ndarray, grad: np.ndarray) -> None:
        total = np.zeros_like(self.embedding.value)
        for lo, bucket, owner, counts in self.blocks(words):
            spread = grad[lo:lo + len(counts)] / counts[:, None]
            for k in range(grad.shape[1]):
                total[:, k] += np.bincount(bucket, spread[owner, k], BUCKETS)
        self.embedding.step(total)


def vocabulary(texts: list[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    """Distinct words and, per text, its words as numbers (with repeats)."""
    number: dict[str, int] = {}
    coded = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in texts]
    return list(number), coded


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_noisy_or(texts: list[str], labels: np.ndarray, dim: int, epochs: int, seed: int = 1, batch: int = 32) -> Model:
    """A text carries label 1 as far as one of its words does.

    The softmax gives each word a probability; a text has the label unless all
    of its words miss it.  The gradient reaches softmax and embedding together.
    """
    lists = [sorted({p for w in set(words_of(t)) for p in pieces(w)}) for t in texts]
    names, coded = vocabulary(lists)
    trainer = Trainer(names, 2, dim, seed, 0.03)
    trainer.bias.value[:] = (2.5, -2.5)
    rng = np.random.default_rng(seed)
    usable = np.array([i for i, c in enumerate(coded) if len(c)], dtype=np.int64)
    if not len(usable):
        trainer.bias.value[:] = (30, -30)
    for _ in range(epochs):
        rng.shuffle(usable)
        for lo in range(0, len(usable), batch):
            docs = usable[lo:lo + batch]
            words, inverse = np.unique(np.concatenate([coded[i] for i in docs]), return_inverse=True)
            doc = np.repeat(np.arange(len(docs)), [len(coded[i]) for i in docs])
            vectors, kept = trainer.forward(words)
            p = np.clip(softmax(vectors @ trainer.weight.value.T + trainer.bias.value)[:, 1], LEAST, 1 - LEAST)
            missed = np.bincount(doc, np.log1p(-p[inverse]), len(docs))
            hit = -np.expm1(missed)
            y = labels[docs]
            factor = np.where(y == 1, -(1 - hit) / np.maximum(hit, 1e-9), 1.0)  # d loss / d log-odds = factor * p
            slope = np.bincount(inverse, factor[doc], len(words)) * p / len(docs)
            both = np.stack([-slope, slope], axis=1)
            grad = both @ trainer.weight.value
            trainer.weight.step(both.T @ vectors)
            trainer.bias.step(both.sum(axis=0))
            trainer.backward(kept, grad)
    return Model(["0", "1"], trainer.embedding.value, trainer.weight.value, trainer.bias.value)


def fit_bag(texts: list[str], labels: list[str], dim: int, epochs: int, seed: int = 1, batch: int = 64,
            words_per_step: int = 120) -> Model:
    """Mean of all word vectors into a softmax over the labels, by stochastic gradient descent.

    Every fifth text is kept for calibration: a temperature that makes the
    probabilities honest, and the score below which a text is rejected, which
    one in two hundred rightly classified texts falls under.
    """
    classes = sorted(set(labels))
    lists = [[p for w in words_of(t) for p in pieces(w)] for t in texts]
    keep = [i for i, ws in enumerate(lists) if ws]
    names, coded = vocabulary([lists[i] for i in keep])
    y = np.array([classes.index(labels[i]) for i in keep], dtype=np.int64)
    trainer = Trainer(names, max(len(classes), 1), dim, seed, 0.02)
    rng = np.random.default_rng(seed)
    fit_on = np.array([i for i in range(len(keep)) if i % 5], dtype=np.int64)
    for _ in range(epochs):
        rng.shuffle(fit_on)
        for lo in range(0, len(fit_on), batch):
            docs = fit_on[lo:lo + batch]
            drawn = [rng.choice(coded[i], min(len(coded[i]), words_per_step), replace=False) for i in docs]
            words, inverse = np.unique(np.concatenate(drawn), return_inverse=True)
            sizes = np.array([len(d) for d in drawn])
            starts = np.cumsum(sizes) - sizes
            vectors, kept = trainer.forward(words)
            mean = np.add.reduceat(vectors[inverse], starts, axis=0) / sizes[:, None]
            p = softmax(mean @ trainer.weight.value.T + trainer.bias.value)
            p[np.arange(len(docs)), y[docs]] -= 1
            p /= len(docs)
            grad_doc = (p @ trainer.weight.value) / sizes[:, None]
            doc = np.repeat(np.arange(len(docs)), sizes)
            grad = np.stack([np.bincount(inverse, grad_doc[doc, k], len(words)) for k in range(grad_doc.shape[1])], axis=1)
            trainer.weight.step(p.T @ mean)
            trainer.bias.step(p.sum(axis=0))
            trainer.backward(kept, grad)
    model = Model(classes, trainer.embedding.value, trainer.weight.value, trainer.bias.value, temperature=1.0, reject=0.0)
    held = [i for i in range(len(keep)) if i % 5 == 0]
    if held and len(classes) > 1:
        means = gram_means(names, model.table())
        logits = np.stack([means[coded[i]].mean(axis=0) for i in held]) + model.bias
        truth = y[held]
        best = min((-np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), truth], 1e-12)).mean(), t)
                   for t in np.geomspace(0.1, 10, 41))
        p = softmax(logits / best[1])
        right = p.max(axis=1)[p.argmax(axis=1) == truth]
        model.scalars = {"temperature": float(best[1]), "reject": float(np.quantile(right, 0.005)) if len(right) else 0.0}
    return model
