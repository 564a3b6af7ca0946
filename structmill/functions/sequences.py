"""Sequence functions: types, normalisation, reports on text lengths, alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values.
MACROMOLECULES = {
    "Polyribonucleotide (RNA)": "rna",
    "polyribonucleotide": "rna",
    "Polydeoxyribonucleotide (DNA)": "dna",
    "polydeoxyribonucleotide": "dna",
    "DNA/RNA Hybrid": "hybrid",
    "polydeoxyribonucleotide/polyribonucleotide hybrid": "hybrid",
}
RNA, DNA = ("A", "C", "G", "U"), ("DA", "DC", "DG", "DT", "DU", "DI")
AMINO_ACIDS = "ALA ARG ASN ASP CYS GLN GLU GLY HIS ILE LEU LYS MET PHE PRO SER THR TRP TYR VAL".split()


def macromolecule(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in MACROMOLECULES.items() for x in kv])[kind]


def unit_type(unit: Column) -> Column:
    """rna, dna, aa, water or null."""
    return F.when(unit.isin(*RNA), "rna").when(unit.isin(*DNA), "dna").when(unit.isin(*AMINO_ACIDS), "aa").when(unit == "HOH", "water")


def normalised(sequence: Column, parents: dict[str, str], known: str = "ACGUN") -> Column:
    """Known letters pass, others become their parent; a letter without one makes the result null, but the last letter is then dropped."""
    table = F.create_map(*[F.lit(x) for kv in {**{c: c for c in known}, **parents}.items() for x in kv])
    mapped = F.transform(F.split(sequence, ""), lambda c: table[c])
    head = F.slice(mapped, F.lit(1), F.greatest(F.size(mapped) - 1, F.lit(0)))
    broken = F.exists(head, lambda c: c.isNull())
    return F.when(~broken, F.array_join(mapped, ""))


def sequence_row(rows: DataFrame, parents: dict[str, str]) -> DataFrame:
    """Adds md5, length, normalized, normalized_length and was_normalized."""
    out = rows.withColumn("md5", F.md5("sequence")).withColumn("length", F.length("sequence")).withColumn("normalized", normalised(F.col("sequence"), parents))
    return out.withColumn("normalized_length", F.length("normalized")).withColumn("was_normalized", F.col("normalized").isNotNull() & (F.col("normalized") != F.col("sequence")))


def positions(rows: DataFrame, ident: str) -> DataFrame:
    """ident, index (from 0), unit, normalized_unit: a row per letter."""
    both = F.arrays_zip(F.split("sequence", "").alias("unit"), F.split("normalized", "").alias("normalized_unit"))
    each = rows.select(ident, F.posexplode(both).alias("index", "u"))
    return each.select(ident, "index", "u.unit", "u.normalized_unit")


def strand_sequence(strands: Column, modified: Column | None = None) -> Column:
    """Strands of letters joined by *; longer names (modified) stand in parentheses."""
    letter = lambda u: F.when(F.length(u) == 1, u).otherwise(F.concat(F.lit("("), u, F.lit(")")))
    return F.array_join(F.transform(strands, lambda s: F.array_join(F.transform(s, letter), "")), "*")


def swapped_strands(sequence: Column) -> Column:
    """The second strand first."""
    return F.array_join(F.reverse(F.split(sequence, r"\*")), "*")


def align(a: str, b: str, match: float = 1.0, mismatch: float = -1.0, gap: float = -1.0) -> list[tuple[int, int]]:
    """Global alignment (Needleman-Wunsch): pairs of indices, -1 for a gap; of equal ways the diagonal, then a gap in b."""
    n, m = len(a), len(b)
    same = np.array(list(a))[:, None] == np.array(list(b))[None, :] if n and m else np.zeros((n, m), bool)
    score = np.zeros((n + 1, m + 1))
    score[:, 0], score[0] = gap * np.arange(n + 1), gap * np.arange(m + 1)
    ramp = gap * np.arange(m + 1)
    for i in range(1, n + 1):
        row = np.maximum(score[i - 1, 1:] + gap, score[i - 1, :-1] + np.where(same[i - 1], match, mismatch))
        row = np.append(score[i, 0], row)
        score[i] = np.maximum.accumulate(row - ramp) + ramp  # gaps in a
    out, i, j = [], n, m
    while i or j:
        if i and j and np.isclose(score[i, j], score[i - 1, j - 1] + (match if same[i - 1, j - 1] else mismatch)):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and np.isclose(score[i, j], score[i - 1, j] + gap):
            i -= 1
            out.append((i, -1))
        else:
            j -= 1
            out.append((-1, j))
    return out[::-1]


def aligned_positions(pairs: DataFrame) -> DataFrame:
    """correspondence_id, index, position_1, position_2 (null: gap) for rows correspondence_id, sequence_1, sequence_2."""

    def each(batches):
        for rows in batches:
            out = []
            for r in rows.itertuples():
                found = [(i, i) for i in range(len(r.sequence_1))] if r.sequence_1 == r.sequence_2 else align(r.sequence_1, r.sequence_2)
                out += [(r.correspondence_id, k, None if i < 0 else i, None if j < 0 else j) for k, (i, j) in enumerate(found)]
            yield pd.DataFrame(out, columns=["correspondence_id", "index", "position_1", "position_2"]).astype({"position_1": "Int32", "position_2": "Int32"})

    return pairs.select("correspondence_id", "sequence_1", "sequence_2").mapInPandas(each, "correspondence_id long, index int, position_1 int, position_2 int")
