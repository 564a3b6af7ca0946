"""STAGES of the training-data pipeline; each reads what the one before has kept.

Toxic documents go, one document of each near-copy component stays, documents
with benchmark windows go, personal data is redacted, and sources are mixed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from structmill.llm import decontaminate, jaccard, mixing, pii, toxicity
from structmill.llm.shared import saved


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark, docs, sf_dir):
    """Rows predicted toxic go; null and empty texts get the prior, repeated rows are judged alike."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark, docs, sf_dir):
    """Five-word shingles and a similarity of 0.8 or more; rows without words all stay, but for repeats of one doc_id and text."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Rows with a word inside a benchmark window go; null texts have no words."""
    return decontaminate.keep_uncontaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark, docs, sf_dir):
    """All rows stay; spans in texts become their kind in brackets, null texts stay null."""
    return pii.redact(docs)


def mix_sources(spark, docs, sf_dir):
    """The columns of documents, then size, source_size, target, taken and draws (pass, shard, place); documents not taken go.

    A column of documents that has one of these names is called doc_<name>.
    """
    own = {c: f"doc_{c}" if c in ("size", "source_size", "target", "taken", "draws") else c for c in docs.columns}
    mixed = mixing.mix(docs.withColumnsRenamed(own), keep=tuple(own.values())).where(F.size("draws") > 0)
    return mixed.select(*own.values(), "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"), "draws")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("mixing", mix_sources),
]
#: SQL can't express the classifier, the CRF or the seeded draws.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each written and read again as the next one's documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
