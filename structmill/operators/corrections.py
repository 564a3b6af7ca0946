"""Unit ids brought back to ids that exist, single columns of tables with them, and problems of species assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from structmill.operators.relational import assert_none
from structmill.shared import discard, saved

KEY = ("pdb", "model", "chain", "number", "ins_code", "alt_id", "symmetry")
#: The columns of a key that rewrites change, and those that they keep.
CHANGED = ("model", "alt_id", "symmetry")
KEPT = ("pdb", "chain", "number", "ins_code")
#: The identity, the identity of viral structures, the first alternate, and what species are not.
IDENTITY, VIRAL, FIRST_ALTERNATE, SYNTHETIC_NAME = "1_555", "P_1", "A", "synthetic construct"


def decoded(unit_id: Column) -> Column:
    """The key of a unit id pdb|model|chain|component|number|atom|alt|ins|symmetry: blanks are null, without a symmetry the identity."""
    part = lambda k: F.nullif(F.get(F.split(unit_id, r"\|"), F.lit(k)), F.lit(""))
    return F.struct(part(0).alias("pdb"), part(1).try_cast("int").alias("model"), part(2).alias("chain"), part(4).try_cast("int").alias("number"), part(7).alias("ins_code"), part(6).alias("alt_id"), F.coalesce(part(8), F.lit(IDENTITY)).alias("symmetry"))


def rewrites(key: Column) -> Column:
    """The keys to try for a key, in order; null where a rewrite does not apply."""
    model, alt, symmetry = key["model"], key["alt_id"], key["symmetry"]

    def changed(when: Column, **new: Column) -> Column:
        return F.when(when, F.struct(*[new.get(c, key[c]).alias(c) for c in KEY]))

    one, first, viral = F.lit(1), F.lit(FIRST_ALTERNATE), F.lit(VIRAL)
    turned, plain, no_alt = (model != 1) & (symmetry != IDENTITY), symmetry == IDENTITY, alt.isNull()
    return F.array(
        changed(F.lit(True)),
        changed(turned, model=one),
        changed(no_alt, alt_id=first),
        changed(no_alt & turned, alt_id=first, model=one),
        changed(plain, symmetry=viral),
        changed(plain & no_alt, symmetry=viral, alt_id=first),
        changed(model == 2, model=one),
    )


def corrected(wanted: DataFrame, known: DataFrame, *, require_all: bool = True) -> DataFrame:
    """unit, corrected: the first rewrite of each wanted unit's key that a known unit has.

    Both have a column unit.  Two known units of one key, a wanted one without correction (if all are required) and two wanted ones of
    one correction are errors.
    """
    there = known.select(F.col("unit").alias("corrected"), decoded(F.col("unit")).alias("k"))
    # what no rewrite changes, as one value whose nulls equal each other, leads to all known units that one could find
    kept = F.struct(*[F.col(f"k.{c}").alias(c) for c in KEPT]).alias("kept")
    listed = F.collect_set(F.struct(*[F.col(f"k.{c}").alias(c) for c in CHANGED], "corrected"))
    there = saved(there.groupBy(kept).agg(listed.alias("known")), "known-units")
    keys = F.transform("known", lambda x: F.struct(*[x[c] for c in CHANGED]))
    assert_none(there.where(F.size(F.array_distinct(keys)) < F.size("known")), "several units of")
    # units are dealt once by that value, and what a rewrite changes is read from them again below the join, not shuffled
    asked = wanted.select("unit", decoded(F.col("unit")).alias("k")).select("unit", kept).repartition("kept").distinct()
    asked = asked.withColumn("k", decoded(F.col("unit")))

    def there_is(key: Column) -> Column:
        equal = lambda x: x["model"].eqNullSafe(key["model"]) & x["alt_id"].eqNullSafe(key["alt_id"]) & x["symmetry"].eqNullSafe(key["symmetry"])
        return F.when(key.isNotNull(), F.get(F.filter("known", equal), F.lit(0))["corrected"])

    first = F.get(F.filter(F.transform(rewrites(F.col("k")), there_is), lambda x: x.isNotNull()), F.lit(0))
    matched = asked.join(there, "kept").select("kept", "unit", first.alias("corrected")).where("corrected IS NOT NULL")
    # two units of one correction share what no rewrite changes
    of = F.count("*").over(Window.partitionBy("kept", "corrected"))
    found = saved(matched.withColumn("of", of).select("unit", "corrected", "of"), "corrected")
    discard(there)
    if require_all:
        assert_none(wanted.select("unit").distinct().join(found, "unit", "left_anti"), "could not correct")
    assert_none(found.where("of > 1").select("corrected", "of"), "several units became")
    return found.drop("of")


def corrected_column(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """The rows with every id of one column corrected; ids that have no correction, and nulls, stay."""
    found = corrected(rows.where(F.col(column).isNotNull()).select(F.col(column).alias("unit")), known, require_all=False)
    fixed = found.select(F.col("unit").alias(column), F.col("corrected").alias("_corrected"))
    return rows.join(fixed, column, "left").select(*[F.coalesce("_corrected", column).alias(c) if c == column else F.col(c) for c in rows.columns])


def species_problems(chains: DataFrame, known: DataFrame) -> DataFrame:
    """id, problems (joined by ``; ``) of the chains with any: unlikely and missing names, and species that their sequence should not have.

    ``chains``: id, sequence, species_id, species_name; ``known``: sequence, species_name (those expected).  A sequence with expected species
    is checked against them, others for more than one; unnamed and synthetic ones count for neither.
    """
    unlikely = F.when(F.col("species_name").contains("sp."), F.concat(F.lit("Unlikely species name: ("), "species_name", F.lit(")")))
    unnamed = F.when((F.coalesce("species_name", F.lit("")) == "") & F.col("species_id").isNotNull(), F.concat(F.lit("Species with no assigned name. Taxon id: "), F.col("species_id").cast("string")))
    named = chains.where(F.col("species_name").isNotNull() & (F.col("species_name") != SYNTHETIC_NAME))
    expected = known.groupBy("sequence").agg(F.array_sort(F.collect_set("species_name")).alias("expected"))
    # ids in a message are those of one species and sequence
    listed = named.groupBy("sequence", "species_name").agg(F.array_join(F.array_sort(F.collect_set("id")), " ").alias("ids"))
    found = listed.groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("species_name", "ids"))).alias("found")).join(expected, "sequence", "left")
    names = F.transform("found", lambda x: x["species_name"])
    wrong = F.array_except(names, F.col("expected"))
    unexpected = F.concat(F.lit("Unexpected species "), F.array_join(wrong, ", "), F.lit(" assigned to this sequence Expected one of "), F.array_join("expected", ", "))
    several = F.concat(F.lit("Multiple species assigned to this sequence: "), F.array_join(F.transform("found", lambda x: F.concat(x["species_name"], F.lit(": ("), x["ids"], F.lit(")"))), ", "))
    shared = found.select("sequence", F.when(F.col("expected").isNotNull(), F.when(F.size(wrong) > 0, unexpected)).when(F.size("found") > 1, several).alias("shared"))
    rows = chains.join(shared, "sequence", "left").select("id", F.concat_ws("; ", unlikely, unnamed, "shared").alias("problems"))
    return rows.where("problems <> ''")
