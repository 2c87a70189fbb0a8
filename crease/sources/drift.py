"""Fields of another type than declared, and fields that are not declared.

The reader's schema turns a value of another type into null.  Here documents are
parsed as VARIANT, without a schema, and every field at every level is compared
with the declared one, so what the schema nulls is kept and reported.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.schemas import MATCH_DOCUMENT

ELEMENT = "[]"  # an element of a list of objects that is no object
_ENTRY = "array<struct<level:string,field:string,declared:string,found:string,value:string>>"


def read_variants(spark: SparkSession, path: str, *, multi_line: bool = False, glob: str = "*.json") -> DataFrame:
    """(source_file, raw, document): documents as text and as VARIANT, which is
    null where the text is no JSON."""
    text = spark.read.option("pathGlobFilter", glob).option("wholetext", multi_line).text(path)
    return text.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("raw"), F.try_parse_json("value").alias("document"))


def _kind(value: Column) -> Column:
    """The JSON kind of a variant: object, array, string, number, integer, boolean or null."""

    def named(t: Column) -> Column:
        return (
            F.when(t.isNull() | (t == "VOID"), F.lit("null"))
            .when(t.startswith("OBJECT"), F.lit("object"))
            .when(t.startswith("ARRAY"), F.lit("array"))
            .when(t == "STRING", F.lit("string"))
            .when(t == "BOOLEAN", F.lit("boolean"))
            .when((t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), F.lit("integer"))
            .otherwise(F.lit("number"))
        )

    # through a list, so that the schema is made once, not once for each kind
    return F.get(F.transform(F.array(F.schema_of_variant(value)), named), 0)


def _accepted(declared: T.DataType) -> tuple[str, ...]:
    """Kinds that the reader takes for a declared type; any kind is text to it."""
    if isinstance(declared, T.StringType):
        return ("string", "number", "integer", "boolean", "object", "array", "null")
    if isinstance(declared, T.LongType):
        return ("integer", "null")
    return ("array" if isinstance(declared, T.ArrayType) else "object", "null")


def _name(declared: T.DataType) -> str:
    return declared.typeName() if not isinstance(declared, T.StructType) else "struct"


_SCALAR = r"(?:STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|VOID)"
_NAME = r"(?:\w+|`(?:[^`]|``)*`)"  # a field's name as a schema's text writes it


def _fitting(declared: T.DataType) -> str:
    """Pattern of the schema's text (as ``schema_of_variant`` gives it) of values that
    hold no difference at any depth.  Narrower than what is accepted: a value that does
    not match is looked at field by field.  Objects list their fields by name; an array
    of elements of several types has a type that no pattern takes."""
    if isinstance(declared, T.LongType):
        return r"(?:BIGINT|DECIMAL\(\d+,0\)|VOID)"
    if isinstance(declared, T.StringType):
        return _SCALAR
    if isinstance(declared, T.MapType):
        return rf"(?:VOID|OBJECT<(?:{_NAME}: {_SCALAR}(?:, (?!>)|(?=>)))*>)"
    if isinstance(declared, T.ArrayType):
        element = _fitting(declared.elementType) if isinstance(declared.elementType, T.StructType) else _SCALAR
        return rf"(?:VOID|ARRAY<(?:VOID|{element})>)"
    fields = sorted(declared.fields, key=lambda f: f.name)
    return "(?:VOID|OBJECT<" + "".join(rf"(?:{f.name}: {_fitting(f.dataType)}(?:, (?!>)|(?=>)))?" for f in fields) + ">)"


def _fits(schema: Column, declared: T.DataType) -> Column:
    return schema.rlike(rf"\A{_fitting(declared)}\z")


def _differences(value: Column, declared: T.StructType, level: str) -> Column:
    """Entries (level, field, declared, found, value) of an object and all below it.
    What fits as a whole is not looked into."""
    fields = F.map_entries(F.coalesce(F.try_variant_get(value, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    known = {f.name: f.dataType for f in declared.fields}

    def told(e: Column) -> Column:
        return F.struct(e["key"].alias("key"), e["value"].alias("value"), _kind(e["value"]).alias("kind"))

    def entry(e: Column) -> Column:
        want = ok = None
        for field, kind_of in known.items():
            here = e["key"] == field
            want = F.when(here, F.lit(_name(kind_of))) if want is None else want.when(here, F.lit(_name(kind_of)))
            fits = e["kind"].isin(*_accepted(kind_of))
            ok = F.when(here, fits) if ok is None else ok.when(here, fits)
        return F.struct(
            F.lit(level).alias("level"), e["key"].alias("field"), want.alias("declared"), e["kind"].alias("found"),
            F.when(~F.coalesce(ok, F.lit(False)), F.to_json(e["value"])).alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"),
        )

    own = F.filter(F.transform(F.transform(fields, told), entry), lambda x: ~x["ok"])
    parts = [F.transform(own, lambda x: F.struct(*[x[c].alias(c) for c in ("level", "field", "declared", "found", "value")]))]
    none = F.array().cast(_ENTRY)
    for field, kind_of in known.items():
        below = f"{level}.{field}" if level else field
        inside = F.try_variant_get(value, f"$.{field}", "variant")
        if isinstance(kind_of, T.StructType):
            found = _differences(inside, kind_of, below)
        elif isinstance(kind_of, T.ArrayType) and isinstance(kind_of.elementType, T.StructType):
            items = F.coalesce(F.try_variant_get(value, f"$.{field}", "array<variant>"), F.array().cast("array<variant>"))
            found = F.flatten(F.transform(items, _element(kind_of.elementType, below)))
        else:
            continue
        parts.append(F.when(inside.isNull() | _fits(F.schema_of_variant(inside), kind_of), none).otherwise(found))
    return F.concat(*[p.cast(_ENTRY) for p in parts])


def _element(declared: T.StructType, level: str) -> Callable[[Column], Column]:
    """Entries of one element of a list of objects."""

    def entries(value: Column) -> Column:
        kind = _kind(value)
        odd = F.struct(
            F.lit(level).alias("level"), F.lit(ELEMENT).alias("field"), F.lit("struct").alias("declared"), kind.alias("found"), F.to_json(value).alias("value")
        )
        told = F.when(kind.isin("object", "null"), _differences(value, declared, level)).otherwise(F.array(odd).cast(_ENTRY))
        return F.when(_fits(F.schema_of_variant(value), declared), F.array().cast(_ENTRY)).otherwise(told)

    return entries


def drift_values(documents: DataFrame) -> DataFrame:
    """(source_file, level, field, declared, found, value), a row per value that the
    declared schema turns into null (declared: the type it wants) or does not know
    (declared: null).  ``level`` is the path of the object that holds the field.  No
    shuffle; a document that is no JSON object gives no row (it is quarantined).
    Documents that fit as a whole are told by the text of their schema alone."""
    entries = _differences(F.col("document"), MATCH_DOCUMENT, "")
    documents = documents.filter(~_fits(F.schema_of_variant("document"), MATCH_DOCUMENT))
    return documents.select("source_file", F.explode(entries).alias("e")).select("source_file", "e.*")


def drift_table(documents: DataFrame) -> DataFrame:
    """(level, field, declared, found, n_values), a row per kind of difference."""
    return drift_values(documents).groupBy("level", "field", "declared", "found").agg(F.count(F.lit(1)).alias("n_values"))
