"""Toxic texts: subword-bag embeddings under a linear softmax, trained jointly in numpy.

This departs from the plain method, which averages the words of a text: the
README has figures for both.  Word vectors are means of hashed n-gram vectors, so misspelled or inflected
forms of a slur score like the slur.  A text is toxic unless all of its words
miss it: training and scoring join the distinct words by the same noisy-or.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.frames import bounded_sample, fitted, fold
from tickwell.llm.subword import LEAST, Model, WordScores, fit_noisy_or, pieces, words_of

SAMPLE = 800  # labelled texts of each class the classifier is fitted on, at most
DIM = 8
EPOCHS = 8
THRESHOLD = 0.3


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, held_out: int | None = 2, folds: int = 4) -> bytes:
    """Model fitted on a bounded sample of labelled texts outside the held-out fold.

    Null texts and labels are left out; of an id that repeats one text counts,
    the smallest by hash, so a repeated id does not fill the sample.  Without
    any labelled text no word is taken as toxic.
    """
    marks = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where(
        F.col("_y").isin(0, 1) & F.col("_id").isNotNull())
    if held_out is not None:
        marks = marks.where(fold("_id", folds) != held_out)
    picked = bounded_sample(marks.where("_y = 1"), sample).unionByName(bounded_sample(marks.where("_y = 0"), sample)).distinct()
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where("_text IS NOT NULL")
    # Both classes together hold at most two samples of ids, so this side has a fixed bound.
    found = texts.join(F.broadcast(picked), "_id")
    joined = found.groupBy("_id", "_y").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_text", "_y")

    def fit(frame: pd.DataFrame) -> bytes:
        frame = frame.sort_values(["_y", "_text"], kind="stable")
        return fit_noisy_or(frame["_text"].tolist(), frame["_y"].to_numpy(), DIM, EPOCHS).dump()

    return fitted(joined, fit)


def noisy_or(odds) -> float:
    """Probability that at least one of the words carries the label, with the bounds of training; sorted, so that their order does not count."""
    import numpy as np
    p = np.clip(1 / (1 + np.exp(-np.clip(np.sort(odds), -60, 60))), LEAST, 1 - LEAST)
    return float(-np.expm1(np.log1p(-p).sum()))


def scorer(blob: bytes):
    """Column function: the whole text's probability of being toxic; null and empty texts, without a word, get 0."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        import numpy as np
        model = _loaded(blob)
        out = []
        for lo in range(0, len(texts), WordScores.TEXTS):
            found = [{p for w in set(words_of(t)) for p in pieces(w)} for t in texts.iloc[lo:lo + WordScores.TEXTS]]
            model.add(set().union(*found))
            known, odds = model.known, model.scores[:, 1]  # class 0 is the zero of the odds
            out += [noisy_or(odds[np.fromiter((known[w] for w in ws), np.int64, len(ws))] + model.bias) for ws in found]
        return pd.Series(out, dtype="float64")

    return score


_MODELS: dict[int, WordScores] = {}


def _loaded(blob: bytes) -> WordScores:
    """The model of this Python worker, unpacked once."""
    key = hash(blob)
    if key not in _MODELS:
        _MODELS.clear()
        model = Model.load(blob)
        scores = WordScores(model, "pieces")
        scores.bias = float(model.bias[1] - model.bias[0])
        _MODELS[key] = scores
    return _MODELS[key]


def toxic_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    Null ids count as fold 0; repeated rows are scored each; texts of any length
    are scored whole; an empty table gives an empty result.  Other columns of ``documents`` are not looked at.
    """
    score = scorer(train(documents, labels))
    return documents.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    score = scorer(train(documents, labels))
    return documents.where(score(F.col("text")) < threshold)
