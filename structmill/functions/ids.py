"""Structured identifiers as columns.

unit id: pdb|model|chain|unit|number[|atom|alt|insertion|symmetry]; chain triple:
pdb|model|chain; element id: triples joined by +; loop id: TYPE_PDB_SEQ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SYMMETRY = "1_555"
FIELDS = ("pdb", "model", "chain", "unit", "number", "atom", "alt_id", "ins_code", "sym_op")


def unit_fields(unit_id: Column) -> Column:
    """A struct of the nine fields; empty and left-out ones are null, a left-out symmetry is the default one; null for fewer than five fields."""
    parts = F.split(unit_id, r"\|")
    field = lambda i: F.nullif(F.try_element_at(parts, F.lit(i)), F.lit(""))
    out = [field(i + 1).alias(n) for i, n in enumerate(FIELDS[:8])]
    return F.when(F.size(parts).between(5, 9), F.struct(*out, F.coalesce(field(9), F.lit(DEFAULT_SYMMETRY)).alias("sym_op")))


def chain_triple(unit_id: Column) -> Column:
    return F.array_join(F.slice(F.split(unit_id, r"\|"), 1, 3), "|")


def element_chains(element_id: Column) -> Column:
    return F.split(element_id, r"\+")


def loop_id(kind: Column, pdb: Column, number: Column) -> Column:
    """The number has three digits, or six beyond 999."""
    return F.concat_ws("_", kind, pdb, F.when(number > 999, F.lpad(number.cast("string"), 6, "0")).otherwise(F.lpad(number.cast("string"), 3, "0")))


def loop_kind(borders: Column) -> Column:
    """HL for 2 borders, IL for 4, Jn for 2n."""
    return F.when(borders == 2, "HL").when(borders == 4, "IL").when((borders > 4) & (borders % 2 == 0), F.concat(F.lit("J"), (borders / 2).cast("int").cast("string")))


def class_name(prefix: str, cutoff: Column, handle: Column, version: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), cutoff, F.lit("_"), handle, F.lit("."), version.cast("string"))


def sort_key(*numbers_and_texts: tuple[Column, int]) -> Column:
    """Parts padded to fixed widths, so that text order is the order of the parts."""
    return F.concat(*[F.lpad(c.cast("string"), width, "0") for c, width in numbers_and_texts])


def is_near(label: Column) -> Column:
    return label.startswith("n")


def canonical_label(label: Column) -> Column:
    """Without the alternative mark ``a``, edges in upper case; null for near and base-backbone labels."""
    plain = F.regexp_replace(label, "a$", "")
    return F.when(plain.startswith("n") | plain.contains("B"), None).otherwise(F.translate(plain, "whs", "WHS"))


def prefixed_symmetry(unit_id: Column) -> Column:
    """ASM_ in the symmetry field becomes P_."""
    parts = F.split(unit_id, r"\|")
    return F.array_join(F.transform(parts, lambda x, i: F.when(i == 8, F.regexp_replace(x, "^ASM_", "P_")).otherwise(x)), "|")
