"""Composite quality scores and the status cascade of loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score coefficients.
CQS1 = {"resolution": 1, "percent_clash": 0.6, "fraction_unobserved": 4, "average_rsr": 8, "average_rscc": 8, "rfree": 18}
CQS2 = {"resolution": 1, "percent_clash": 1, "fraction_unobserved": 2.9, "rfree": 21, "average_rsr": 6.4, "average_rscc": 7, "average_Q_score": 7.5, "average_residue_inclusion": 5, "constant": 2.8}
MISSING_Q_SCORE, MISSING_INCLUSION = 150, 141
#: What a missing metric counts as.
DEFAULTS = {"average_rsr": 40.0, "average_rscc": -1.0, "rfree": 1.0, "resolution": 100.0}


def with_defaults(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items() if c in rows.columns})


def cqs1() -> Column:
    plain = sum((F.lit(float(CQS1[c])) * F.col(c) for c in ("resolution", "percent_clash", "fraction_unobserved", "average_rsr")), F.lit(0.0))
    return plain + CQS1["average_rscc"] * (1 - F.col("average_rscc")) + CQS1["rfree"] * F.col("rfree")


def cqs2() -> Column:
    """Electron microscopy is scored by its own metrics; either kind pays for missing ones."""
    common = sum((F.lit(float(CQS2[c])) * F.col(c) for c in ("resolution", "percent_clash", "fraction_unobserved")), F.lit(0.0))
    em = F.coalesce(CQS2["average_Q_score"] * (1 - F.col("average_Q_score")), F.lit(float(MISSING_Q_SCORE)))
    em = em + F.coalesce(CQS2["average_residue_inclusion"] * (1 - F.col("average_residue_inclusion")), F.lit(float(MISSING_INCLUSION))) + CQS2["constant"]
    other = CQS2["average_rsr"] * F.col("average_rsr") + CQS2["average_rscc"] * (1 - F.col("average_rscc")) + CQS2["rfree"] * F.col("rfree")
    return common + F.when(F.col("method") == "ELECTRON MICROSCOPY", em).otherwise(other)


#: Fixed values: (status, condition column), the first that holds wins; 1 is valid.
CASCADE = ((2, "has_breaks"), (4, "bad_chain_number"), (7, "too_many_sym_ops"), (5, "has_incomplete"), (6, "is_complementary"), (8, "all_high_rsrz"), (8, "all_low_q_score"), (3, "has_modified"))
STATUS_TEXT = {1: "valid", 2: "missing", 3: "modified", 4: "abnormal", 5: "incomplete", 6: "complementary", 7: "symmetry", 8: "fictional"}


def status() -> Column:
    out = F.when(F.coalesce(F.col(CASCADE[0][1]), F.lit(False)), CASCADE[0][0])
    for code, condition in CASCADE[1:]:
        out = out.when(F.coalesce(F.col(condition), F.lit(False)), code)
    return out.otherwise(1)


def status_text(code: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in STATUS_TEXT.items() for x in kv])[code]


def all_high(values: Column, cutoff: float = 1.0) -> Column:
    """Every value is null or at least the cutoff; false for a structure without values (null)."""
    return F.coalesce(F.forall(values, lambda v: v.isNull() | (v >= cutoff)), F.lit(False))


def all_low(values: Column, cutoff: float = 0.4) -> Column:
    return F.coalesce(F.forall(values, lambda v: v.isNull() | (v < cutoff)), F.lit(False))


#: Chains that a loop of a type may have.
MOST_CHAINS = {"IL": 2, "HL": 1}


def bad_chain_number(kind: Column, chains: Column) -> Column:
    """No chain, or more chains than strands: 1 for HL, 2 for IL, n for Jn."""
    most = F.when(kind == "HL", 1).when(kind == "IL", 2).otherwise(F.try_to_number(F.substring(kind, 2, 5), F.lit("99999")).cast("int"))
    return (chains == 0) | (chains > most)


PAIRS = ("AU", "UA", "CG", "GC", "GU", "UG")


def is_complementary(first: Column, second: Column) -> Column:
    """Two strands pair outside to inside at every position."""
    both = F.zip_with(F.split(first, ""), F.reverse(F.split(second, "")), lambda a, b: F.concat(a, b))
    return (F.length(first) == F.length(second)) & F.forall(both, lambda p: F.coalesce(p.isin(*PAIRS), F.lit(False)))
