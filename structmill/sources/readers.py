"""Readers of the file formats that annotations come in; each yields a DataFrame.

Record formats (mmCIF, FASTA, Stockholm) are read a file a row and parsed in
Arrow batches on the executors; tabular ones use Spark's own readers.
"""

from __future__ import annotations

import gzip
import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The five headerless motif tables.
MOTIF_TABLES = {
    "MotifList": "id string, name string",
    "MotifPositions": "name string, loop_id string, unit_id string, position int",
    "MotifLoopOrder": "name string, loop_id string, original_order int, similarity_order int",
    "MutualDiscrepancy": "loop_id_1 string, discrepancy double, loop_id_2 string",
    "MotifBpSignatures": "name string, bp_signature string",
}


def motif_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A headerless motif table; an empty one is an error."""
    rows = spark.read.csv(f"{folder}/{name}.csv", schema=MOTIF_TABLES[name], quote='"')
    if rows.isEmpty():
        raise ValueError(f"{name}.csv is empty")
    return rows


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Manual annotations, tab separated; empty fields are null."""
    return spark.read.csv(path, sep="\t", schema="motif_id string, loop_id string, annotation string, annotation_2 string, author string, date string")


def loop_file(spark: SparkSession, path: str) -> DataFrame:
    """loop_id, units (array), merged: three tab-separated fields with a comma list."""
    rows = spark.read.csv(path, sep="\t", schema="loop_id string, units string, flag string")
    return rows.select("loop_id", F.split("units", ",").alias("units"), (F.lower("flag") == "merged").alias("merged"))


def partners(loops: DataFrame) -> DataFrame:
    """unit, partners: each unit's set of units that share a loop with it, in both directions."""
    each = loops.select("loop_id", F.explode("units").alias("unit"))
    return each.join(each.withColumnRenamed("unit", "other"), "loop_id").where("unit != other").groupBy("unit").agg(F.array_sort(F.collect_set("other")).alias("partners"))


def search_hits(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated hits of 18 fields, # lines left out."""
    fields = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    names = {"target": (0, "string"), "query": (2, "string"), "model_from": (5, "int"), "model_to": (6, "int"), "seq_from": (7, "int"), "seq_to": (8, "int"), "strand": (9, "string"), "score": (14, "double"), "e_value": (15, "double")}
    return rows.where(F.size(fields) >= 18).select(*[F.element_at(fields, i + 1).try_cast(t).alias(n) for n, (i, t) in names.items()])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _text(content: bytes) -> str:
    return (gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content).decode("utf-8", "replace")


def _parsed(spark, path, parse, schema):
    names = StructType.fromDDL(schema).names

    def each(batches):
        for rows in batches:
            out = [(p, *r) for p, c in zip(rows["path"], rows["content"]) for r in parse(_text(c))]
            yield pd.DataFrame(out, columns=names)

    return _files(spark, path).mapInPandas(each, schema)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """path, id, header, sequence."""
    return _parsed(spark, path, parse_fasta, "path string, id string, header string, sequence string")


def parse_fasta(text: str) -> list[tuple[str, str, str]]:
    out = []
    for record in re.split(r"^>", text, flags=re.M)[1:]:
        header, _, body = record.partition("\n")
        out.append((header.split()[0] if header.split() else "", header.strip(), re.sub(r"\s", "", body)))
    return out


def stockholm(spark: SparkSession, path: str) -> DataFrame:
    """path, id, aligned: each sequence's blocks joined."""
    return _parsed(spark, path, parse_stockholm, "path string, id string, aligned string")


def parse_stockholm(text: str) -> list[tuple[str, str]]:
    out: dict[str, str] = {}
    for line in text.splitlines():
        if line.strip() and line[0] != "#" and line.strip() != "//":
            name, _, letters = line.partition(" ")
            out[name] = out.get(name, "") + letters.strip()
    return list(out.items())


def alignment_columns(aligned: DataFrame) -> DataFrame:
    """id, column, position (null: gap - or .), letter; columns and positions from 1."""
    each = aligned.select("id", F.posexplode(F.split("aligned", "")).alias("column", "letter"), "aligned")
    letters = F.length(F.regexp_replace(F.substring("aligned", F.lit(1), F.col("column") + 1), r"[-.]", ""))
    return each.select("id", (F.col("column") + 1).alias("column"), F.when(~F.col("letter").isin("-", "."), letters).alias("position"), "letter")


def cif_loop(spark: SparkSession, path: str, category: str, columns: list[str]) -> DataFrame:
    """path and the columns of one category of mmCIF files; ? and . are null."""
    schema = "path string, " + ", ".join(f"`{c}` string" for c in columns)
    return _parsed(spark, path, lambda text: parse_cif(text, category, columns), schema)


_TOKEN = re.compile(r"^;(.*?)^;|'((?:[^']|'(?=\S))*)'(?=\s|$)|\"((?:[^\"]|\"(?=\S))*)\"(?=\s|$)|(#[^\n]*)|(\S+)", re.M | re.S)


def parse_cif(text: str, category: str, columns: list[str]) -> list[tuple]:
    tokens = []
    for m in _TOKEN.finditer(text):
        if m[4] is None:
            quoted = next((g for g in m.groups()[:3] if g is not None), None)
            tokens.append((m[5], True) if quoted is None else (quoted.rstrip("\n"), False))
    out, i = [], 0
    single: dict[str, str | None] = {}
    value = lambda t: None if t[1] and t[0] in ("?", ".") else t[0]
    while i < len(tokens):
        token, bare = tokens[i]
        if bare and token.lower() == "loop_":
            names, i = [], i + 1
            while i < len(tokens) and tokens[i][1] and tokens[i][0].startswith("_"):
                names.append(tokens[i][0])
                i += 1
            cells = []
            while i < len(tokens) and not (tokens[i][1] and (tokens[i][0].startswith(("_", "data_")) or tokens[i][0].lower() == "loop_")):
                cells.append(value(tokens[i]))
                i += 1
            if names and names[0].startswith(f"{category}."):
                at = [names.index(f"{category}.{c}") if f"{category}.{c}" in names else None for c in columns]
                out += [tuple(None if k is None else cells[r + k] for k in at) for r in range(0, len(cells) - len(names) + 1, len(names))]
        elif bare and token.startswith(f"{category}.") and i + 1 < len(tokens):
            single[token.split(".", 1)[1]] = value(tokens[i + 1])
            i += 2
        else:
            i += 1
    if single:
        out.append(tuple(single.get(c) for c in columns))
    return out


def atom_units(atoms: DataFrame) -> DataFrame:
    """One row a residue of atom records: identity, number of atoms and mean centre."""
    keys = ["path", "label_asym_id", "label_comp_id", "label_seq_id", "label_alt_id", "pdbx_PDB_ins_code"]
    xyz = [F.avg(F.col(f"Cartn_{a}").cast("double")).alias(a) for a in "xyz"]
    return atoms.groupBy(*keys).agg(F.count("*").alias("atoms"), *xyz)


def validation_residues(spark: SparkSession, path: str) -> DataFrame:
    """path, chain, number, ins_code, alt, rsr, rsrz, rscc of residue elements of validation XML."""
    return _parsed(spark, path, parse_residues, "path string, chain string, number int, ins_code string, alt string, rsr double, rsrz double, rscc double")


def parse_residues(text: str) -> list[tuple]:
    blank = lambda x: None if x is None or not x.strip() or x.strip() == "." else x.strip()
    number = lambda x: None if blank(x) is None else float(x)
    found = ET.fromstring(text).iter("ModelledSubgroup")
    return [(r.get("chain"), int(r.get("resnum")), blank(r.get("icode")), blank(r.get("altcode")), number(r.get("rsr")), number(r.get("rsrz")), number(r.get("rscc"))) for r in found]


def taxonomy(spark: SparkSession, path: str, rank: str = "species") -> DataFrame:
    """path, taxid, name and the lineage's taxon of the wanted rank (itself, if it has it)."""

    def parse(text):
        out = []
        for t in ET.fromstring(text).findall("taxon"):
            chain = [t, *t.findall("lineage/taxon")]
            at = next((x for x in chain if x.get("rank") == rank), None)
            out.append((t.get("taxId"), t.get("scientificName"), None if at is None else at.get("taxId"), None if at is None else at.get("scientificName")))
        return out

    return _parsed(spark, path, parse, "path string, taxid string, name string, rank_taxid string, rank_name string")


def renamed(rows: DataFrame, spec: dict[str, tuple[str, str]], null_if: tuple[str, ...] = ("", "NotAvailable", "?"), *, skip_absent: bool = True) -> DataFrame:
    """Columns old -> (new, type): renamed, trimmed, null where in ``null_if``, cast."""
    out = []
    for old, (new, kind) in spec.items():
        if old not in rows.columns:
            if skip_absent:
                continue
            raise KeyError(old)
        text = F.trim(F.col(f"`{old}`").cast("string"))
        out.append(F.when(~text.isin(*null_if), text).try_cast(kind).alias(new))
    return rows.select(*out)


def validation_clashes(spark: SparkSession, path: str) -> DataFrame:
    """path, place, chain, number, ins_code, alt, model, cid, atom, distance, magnitude of the clash elements within residues of validation XML; place counts them in a file."""
    return _parsed(spark, path, parse_clashes, "path string, place int, chain string, number int, ins_code string, alt string, model int, cid string, atom string, distance double, magnitude double")


def parse_clashes(text: str) -> list[tuple]:
    blank = lambda x: None if x is None or not x.strip() or x.strip() in (".", "NotAvailable") else x.strip()
    cast = lambda x, kind: None if blank(x) is None else kind(x)
    out: list[tuple] = []
    for r in ET.fromstring(text).iter("ModelledSubgroup"):
        key = (r.get("chain"), int(r.get("resnum")), blank(r.get("icode")), blank(r.get("altcode")), cast(r.get("model"), int))
        out += [(len(out) + k, *key, c.get("cid"), c.get("atom"), cast(c.get("dist"), float), cast(c.get("clashmag"), float)) for k, c in enumerate(r.findall("clash"))]
    return out


_LETTER = re.compile(r"\((\w)\) (-?\d+\.\d+) (-?\d+\.\d+) lwstring")
_SCALE = re.compile(r"(\d+\.\d+) (\d+\.\d+) scale")
_TRANSLATE = re.compile(r"(-?\d+\.\d+) (-?\d+\.\d+) translate")
#: Pixels of a point; letters that precede a line of another kind are no diagram unless there are so many; where the left edge starts.
PIXELS, LEAST_LETTERS, LEFT = 96.0 / 72.0, 10, 100.0


def diagrams(spark: SparkSession, path: str) -> DataFrame:
    """path, index, unit, x, y: letters of 2-D diagrams, in pixels from the left and top edge."""
    return _parsed(spark, path, parse_diagram, "path string, index int, unit string, x double, y double")


def parse_diagram(text: str) -> list[tuple[int, str, float, float]]:
    """Scales and translations apply to all letters after them, each within those before it."""
    scale_x, scale_y, at_x, at_y = 1.0, 1.0, 0.0, 0.0
    left, top, letters = LEFT, 0.0, []
    for line in text.splitlines():
        line = re.sub("%.*$", "", line.rstrip())
        if m := _LETTER.fullmatch(line):
            x, y = float(m[2]) * scale_x + at_x, float(m[3]) * scale_y + at_y
            left, top = min(left, x), max(top, y)
            letters.append(("U" if m[1].upper() == "Y" else m[1].upper(), x, y))
        elif m := _SCALE.fullmatch(line):
            scale_x, scale_y = scale_x * float(m[1]), scale_y * float(m[2])
        elif m := _TRANSLATE.fullmatch(line):
            at_x, at_y = at_x + scale_x * float(m[1]), at_y + scale_y * float(m[2])
        elif len(letters) < LEAST_LETTERS:
            letters = []
    return [(k, unit, round(PIXELS * (x - left), 3), round(PIXELS * (top - y), 3)) for k, (unit, x, y) in enumerate(letters)]


def assemblies(spark: SparkSession, path: str) -> DataFrame:
    """path, assembly_id, chain, symmetry_id, symmetry of mmCIF files: which chains an assembly holds under which operators.

    Chains are the authors', each once an assembly and operator; chains unknown to the atoms are left out.  An expression with parentheses or
    the operator P is kept whole under the id 0 (``correspondence.operator_products`` takes it apart).  An assembly without a number follows
    the largest so far.  Files without generators use their integrative assembly details, under the identity.
    """
    return _parsed(spark, path, parse_assemblies, "path string, assembly_id int, chain string, symmetry_id string, symmetry string")


def parse_assemblies(text: str) -> list[tuple[int, str, str, str | None]]:
    author = {label: name for label, name in parse_cif(text, "_atom_site", ["label_asym_id", "auth_asym_id"])}
    operators = dict(parse_cif(text, "_pdbx_struct_oper_list", ["id", "name"]))
    generators = parse_cif(text, "_pdbx_struct_assembly_gen", ["assembly_id", "oper_expression", "asym_id_list"])
    out: list[tuple[int, str, str, str | None]] = []
    if not generators:
        details = parse_cif(text, "_ihm_struct_assembly_details", ["assembly_id", "asym_id"])
        return [(int(a), author.get(c) if author else c, "1", "1_555") for a, c in details if a and c and (not author or author.get(c))]
    largest = 0
    for assembly, expression, labels in generators:
        number = int(assembly) if assembly and assembly.isdigit() else largest + 1
        largest = max(largest, number)
        whole = "(" in expression or "P" in expression
        seen: set[tuple[str, str]] = set()
        for chain in filter(None, (author.get(label) for label in labels.split(","))):
            if whole:
                out.append((number, chain, "0", expression))
                continue
            for operator in expression.split(","):
                if (chain, operator) not in seen:
                    seen.add((chain, operator))
                    out.append((number, chain, operator, operators.get(operator)))
    return out
