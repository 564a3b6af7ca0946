"""Quality scores of whole texts: learned hashed word and character n-gram vectors, averaged, into a softmax.

Case is kept (shouting is a sign of junk).  Defined cases: null, empty and blank
texts get the prior; a null doc_id is scored and never learnt from; repeated rows
score alike; without labels, or with one class only, every score is the smoothed rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from structmill.llm import subword

PARAMS = subword.Params(fold=False, rate=1.0)
MODULUS, HELD = 5, 0


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, params: subword.Params = PARAMS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document, its score (0 to 1, higher: good likelier) and predicted (score >= threshold)."""
    model = subword.fit(docs, labels, "quality", MODULUS, HELD, params)
    return subword.classify(docs, model, params, threshold, keep)


def op7_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; texts without words get the prior, without labels 0.5."""
    return quality(docs, labels).select("doc_id", subword.held_out(MODULUS, HELD).alias("held_out"), "score", "predicted")
