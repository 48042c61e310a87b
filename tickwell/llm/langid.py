"""Language of a text: averaged hashed subword vectors, linear softmax, calibrated rejection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.frames import bounded_sample, fitted, fold
from tickwell.llm.subword import Model, WordScores, fit_bag, softmax, words_of

SAMPLE = 3_000  # labelled texts the classifier is fitted on, at most
DIM = 16
EPOCHS = 4
UNDETERMINED = "und"


def train(documents: DataFrame, sample: int = SAMPLE, held_out: int | None = 1, folds: int = 3) -> bytes:
    """Model fitted on a bounded sample of texts with a language outside the held-out fold, as many of each language."""
    rows = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang")).where(
        "_text IS NOT NULL AND _lang IS NOT NULL")
    if held_out is not None:
        rows = rows.where(fold("_id", folds) != held_out)
    picked = bounded_sample(rows, sample, per="_lang").select("_text", "_lang")

    def fit(frame: pd.DataFrame) -> bytes:
        frame = frame.sort_values(["_lang", "_text"], kind="stable").sample(frac=1, random_state=1)
        return fit_bag(frame["_text"].tolist(), frame["_lang"].tolist(), DIM, EPOCHS).dump()

    return fitted(picked, fit)


_MODELS: dict[int, tuple[Model, WordScores]] = {}


def _loaded(blob: bytes) -> tuple[Model, WordScores]:
    key = hash(blob)
    if key not in _MODELS:
        _MODELS.clear()
        model = Model.load(blob)
        _MODELS[key] = (model, WordScores(model))
    return _MODELS[key]


def predictor(blob: bytes):
    """Column function: struct of language, score and whether the score is below the calibrated limit.

    Null texts, texts without a letter, and any text when nothing was learned
    are ``und`` with score 0 and rejected.
    """
    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        import numpy as np
        model, scores = _loaded(blob)
        langs, values = [], []
        for lo in range(0, len(texts), WordScores.TEXTS):
            part = texts.iloc[lo:lo + WordScores.TEXTS]
            found = [words_of(t) for t in part]
            scores.add({w for ws in found for w in ws})
            known = scores.known
            for text, ws in zip(part, found, strict=True):
                if not ws or not model.classes or not any(map(str.isalpha, text)):
                    langs.append(UNDETERMINED)
                    values.append(0.0)
                    continue
                rows = np.fromiter((known[w] for w in ws), np.int64, len(ws))
                p = softmax((scores.scores[rows].mean(axis=0) + model.bias) / model.scalars["temperature"])
                langs.append(model.classes[int(p.argmax())])
                values.append(float(p.max()))
        reject = [lang == UNDETERMINED or v < model.scalars["reject"] for lang, v in zip(langs, values, strict=True)]
        return pd.DataFrame({"lang": langs, "score": values, "rejected": reject})

    return predict


def languages(documents: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, lang_pred, score, rejected).

    The whole text is read; ``lang``, ``source`` and ``doc_id`` enter only the
    training rows.  Null ids count as fold 0, repeated rows are each judged,
    texts of any length whole, in slices of words; an empty table gives no rows.
    """
    predict = predictor(train(documents))
    found = documents.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), predict("text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))
