"""Toxicity scores of whole texts: subword-bag embeddings averaged into a linear softmax.

Letters A-Z are folded; words and their character 3- to 5-grams share one hashed
table, so misspellings of known words still score.  Defined cases: null, empty
and blank texts get the model's prior; a doc_id that is null is scored and never
learnt from; repeated rows are scored alike, each on its own; without labels, or
with one class only, every score is the smoothed rate.  Learning uses a bounded
hash-ordered sample of labelled rows (``Params.rows``); scoring covers all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import subword

PARAMS = subword.Params(fold=True)
MODULUS, HELD = 3, 1


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, params: subword.Params = PARAMS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document, its score (0 to 1, higher: toxic likelier) and predicted (score >= threshold)."""
    model = subword.fit(docs, labels, "toxic", MODULUS, HELD, params)
    return subword.classify(docs, model, params, threshold, keep)


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; texts without words get the prior, without labels 0.5."""
    return toxicity(docs, labels).select("doc_id", subword.held_out(MODULUS, HELD).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    model = subword.fit(docs, labels, "toxic", MODULUS, HELD, PARAMS)
    named = subword.prefixed(docs)
    clean = subword.classify(named, model, PARAMS, threshold, tuple(named.columns)).where(F.col("predicted") == 0)
    return clean.select(*[F.col(n).alias(c) for n, c in zip(named.columns, docs.columns)])
