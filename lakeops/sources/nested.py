"""JSON and XML texts as columns: a schema merged from all rows, malformed rows apart, nested arrays as rows.

Everything is a projection or one aggregate of Spark's own functions; nothing is shuffled but merged schemas.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from lakeops.operators.names import column, fresh_name

_TOKEN = re.compile(r"(`(?:[^`]|``)*`)|([A-Za-z_]\w*)(?=: )|OBJECT<>|\b(?:OBJECT|VARIANT|VOID)\b")
_AS_TYPE = {"OBJECT<>": "STRING", "OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def _as_ddl(schema: str) -> str:
    """A merged schema as DDL; values of several kinds, of none, and empty objects become texts."""
    def replace(found: re.Match) -> str:
        if found.group(1):
            return found.group(1)
        return f"`{found.group(2)}`" if found.group(2) else _AS_TYPE[found.group(0)]

    return _TOKEN.sub(replace, schema)


def infer_json_schema(df: DataFrame, name: str) -> StructType:
    """The fields of all JSON objects in a text column, merged over all rows; other rows take no part.

    Whole numbers are bigint, others decimals wide enough or doubles; a field that holds several kinds of values, or
    only nulls, is a string (the value's JSON text). Each task merges its rows, so one small schema per task is shuffled.
    """
    value = F.try_parse_json(F.col(column(name)))
    merged = df.filter(F.schema_of_variant(value).startswith("OBJECT")).agg(F.schema_of_variant_agg(value)).first()[0]
    ddl = _as_ddl(merged or "OBJECT<>")
    return DataType.fromDDL(ddl) if ddl != "STRING" else StructType([])


def _distinct_names(kind: DataType) -> DataType:
    """The type with fields renamed that differ from an earlier one by case only, which Spark could not tell apart."""
    if isinstance(kind, ArrayType):
        return ArrayType(_distinct_names(kind.elementType))
    if not isinstance(kind, StructType):
        return kind
    taken, fields = set(), []
    for f in kind.fields:
        name, n = f.name, 1
        while name.lower() in taken:
            n += 1
            name = f"{f.name}_{n}"
        taken.add(name.lower())
        fields.append(StructField(name, _distinct_names(f.dataType)))
    return StructType(fields)


def _parsed(df: DataFrame, text: Column, whole: Column, schema: StructType, parse, name: str, bad: str) -> DataFrame:
    """Add ``name`` and ``bad``; ``whole`` is false for texts that the lenient parser must not accept."""
    clash = [c for c in (name, bad) if c.lower() in {d.lower() for d in df.columns}]
    if clash or name.lower() == bad.lower():
        raise ValueError(f"columns {clash or [name]} are taken")
    corrupt, work = "_corrupt", fresh_name(df, "_parsed")
    while corrupt in schema.names:
        corrupt = "_" + corrupt
    got = parse(text, StructType([*schema.fields, StructField(corrupt, StringType())]),
                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    unique = _distinct_names(schema)
    fine = F.coalesce(whole, F.lit(False)) & F.col(work).isNotNull() & F.col(work)[corrupt].isNull()
    kept = F.col(work).cast(StructType([*unique.fields, StructField(corrupt, StringType())])).dropFields(corrupt)
    return df.withColumn(work, got).select(
        *[F.col(column(c)) for c in df.columns], F.when(fine, kept).alias(name),
        F.when(text.isNotNull() & ~fine, text).alias(bad))


def parse_json(df: DataFrame, name: str, schema: StructType | None = None, into: str = "parsed",
               bad: str = "malformed") -> DataFrame:
    """Add ``into``, the JSON objects of a text column, and ``bad``, the texts that are none or do not fit the schema.

    Without ``schema`` it is inferred from all rows, which reads them once more. A missing field is NULL, a field the
    schema lacks is ignored, NULL texts give NULL in both. Field names that differ by case only get a number. As in
    Spark's own reader, what follows a whole object in a text is not looked at.
    """
    schema = infer_json_schema(df, name) if schema is None else schema
    if not schema.fields:
        raise ValueError(f"{name} holds no JSON object with a field")
    text = F.col(column(name))
    return _parsed(df, text, F.try_parse_json(text).isNotNull(), schema, F.from_json, into, bad)


def parse_xml(df: DataFrame, name: str, schema: StructType, into: str = "parsed", bad: str = "malformed") -> DataFrame:
    """The same for one XML element per text; attributes are fields with ``_`` in front. The schema must be given."""
    text = F.col(column(name))
    return _parsed(df, text, F.lit(True), schema, lambda c, s, o: F.from_xml(c, s.simpleString(), o), into, bad)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | None = None) -> DataFrame:
    """The elements ``row_tag`` of XML files as rows; without ``schema`` one is merged from all of them."""
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).xml(path)


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Fields of structs, to any depth, as columns called outer + separator + inner; arrays and maps stay.

    A name that is taken gets a number. A NULL struct gives NULL fields.
    """
    out, taken = [], set()

    def add(value: Column, kind: DataType, name: str) -> None:
        if isinstance(kind, StructType) and kind.fields:
            for f in kind.fields:
                add(value.getField(f.name), f.dataType, f"{name}{separator}{f.name}")
            return
        unique, n = name, 1
        while unique.lower() in taken:
            n += 1
            unique = f"{name}{separator}{n}"
        taken.add(unique.lower())
        out.append(value.alias(unique))

    for f in df.schema.fields:
        add(F.col(column(f.name)), f.dataType, f.name)
    return df.select(*out)


def explode_path(df: DataFrame, path: list[str], keep: list[str], outer: bool = False) -> DataFrame:
    """One row per element of the arrays along ``path``, which leads from a column through fields to a value.

    Every array on the way is opened, arrays of arrays too, to any depth. Out come ``keep``, a place from 0 per array
    (named after the step, with ``_pos``, ``_pos_2`` ...) and the value under the last step's name. Arrays beside the
    path stay closed, so no combinations of unrelated elements arise. With ``outer`` a NULL or empty array gives one
    row with a NULL place; otherwise none.
    """
    value = fresh_name(df.select(*[column(k) for k in keep]), "_value")
    rows = df.select(*[F.col(column(k)) for k in keep], F.col(column(path[0])).alias(value))
    places: list[str] = []
    for i, step in enumerate(path):
        if i:
            kind = rows.schema[value].dataType
            if not isinstance(kind, StructType) or step not in kind.names:
                raise ValueError(f"there is no field {step} in {'.'.join(path[:i])}: {kind.simpleString()}")
            rows = rows.withColumn(value, F.col(value).getField(step))
        depth = 0
        while isinstance(rows.schema[value].dataType, ArrayType):
            depth += 1
            place = fresh_name(rows, f"{step}_pos" if depth == 1 else f"{step}_pos_{depth}")
            opened = (F.posexplode_outer if outer else F.posexplode)(value).alias(place, "_element")
            rows = rows.select(*[F.col(column(c)) for c in rows.columns if c != value], opened).withColumnRenamed(
                "_element", value)
            places.append(place)
    last = fresh_name(rows.drop(value), path[-1])
    return rows.select(*[F.col(column(k)) for k in keep], *places, F.col(value).alias(last))
