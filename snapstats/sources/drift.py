"""Payloads whose fields drift: what the schema of a data set does not name, or cannot read, kept and counted.

Documents are read as VARIANT, without a schema, so no field is lost before it can be looked at. Works on batches and streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapstats import schemas as S

EXTRAS = "extras"
# JSON types (as VARIANT names them) that a named type can be read from; text is read from anything.
_READABLE = {
    "bigint": ("bigint",), "integer": ("bigint",), "double": ("bigint", "decimal", "double", "float"), "boolean": ("boolean",),
    "struct": ("object",), "map": ("object",), "array": ("array",),
}


def documents(reader, path, lines: bool = False) -> DataFrame:
    """Payload objects of landing files as one VARIANT column ``document``, by a batch or a stream reader.

    An array is one document a member. Texts that are no JSON give none (``readers.read_rejects`` lists them).
    """
    raw = reader.text(path, wholetext=not lines).select(F.try_parse_json("value").alias("v"))
    members = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    found = raw.filter(F.col("v").isNotNull()).select(F.explode(members).alias("document"))
    return found.filter(F.schema_of_variant("document").startswith("OBJECT"))


def extras(document: Column | str, dataset: str) -> Column:
    """Fields of a document that are unknown or retyped, as they came: a map from path (``countryInfo.zip``) to VARIANT."""
    schema = S.raw_schema(dataset)
    odd = F.filter(_fields(document, schema), lambda f: _status(f["field"], json_type(f["value"]), schema).isNotNull())
    return F.map_from_entries(odd)


def with_extras(docs: DataFrame, dataset: str) -> DataFrame:
    """Columns of the schema, converted where they can be and else null, and ``extras``; ``readers.from_payload`` takes the rows."""
    column = lambda f: F.try_variant_get("document", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name)
    return docs.select(*map(column, S.raw_schema(dataset).fields), extras("document", dataset).alias(EXTRAS))


def drift(docs: DataFrame, dataset: str) -> DataFrame:
    """dataset, field, status, type and documents: where documents and schema differ.

    ``unknown`` fields the schema does not name, ``retyped`` ones that hold another JSON type than can be read, ``missing`` ones
    that the document lacks (a renamed field is unknown under one name and missing under the other). Nulls have no type and are
    never retyped; the fields of a struct that is missing or null are not missing as well. Each task sends one row per field, status
    and type.
    """
    schema = S.raw_schema(dataset)
    fields = docs.select(_fields("document", schema).alias("fields"))
    present = F.transform("fields", lambda f: F.struct(f["field"].alias("field"), json_type(f["value"]).alias("type")))
    absent = F.transform(_expected("fields", schema), lambda name: F.struct(name.alias("field"), F.lit(None).cast("string").alias("type")))
    found = fields.select(F.explode(F.concat(present, absent)).alias("f")).select("f.*")
    return (
        found.withColumn("status", F.coalesce(_status(F.col("field"), F.col("type"), schema), F.when(F.col("type").isNull(), "missing")))
        .filter(F.col("status").isNotNull())
        .groupBy(F.lit(dataset).alias("dataset"), "field", "status", "type").agg(F.count(F.lit(1)).alias("documents"))
    )


def _status(field: Column, kind: Column, schema: T.StructType) -> Column:
    """``unknown``, ``retyped`` or null of a field that is there, by the name of its JSON type."""
    named = dict(_named(schema))
    accepted = F.create_map(*[x for name, as_type in named.items() if as_type in _READABLE
                              for x in (F.lit(name), F.array(*map(F.lit, (*_READABLE[as_type], "void"))))])
    return F.when(~field.isin(list(named)), "unknown").when(~F.array_contains(F.try_element_at(accepted, field), kind), "retyped")


def json_type(value: Column) -> Column:
    """Name of a VARIANT's type without its parts: bigint, decimal, double, string, boolean, object, array or void."""
    return F.coalesce(F.lower(F.regexp_extract(F.schema_of_variant(value), "^[A-Za-z]+", 0)), F.lit("void"))


def _entries(value: Column, prefix: str) -> Column:
    members = F.map_entries(F.coalesce(value.try_cast("map<string, variant>"), F.create_map().cast("map<string, variant>")))
    return F.transform(members, lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("field"), e["value"].alias("value")))


def _fields(document: Column | str, schema: T.StructType, prefix: str = "", at: str = "$") -> Column:
    """All fields of a document, those of structs the schema names after the struct itself; maps are one field."""
    document = F.col(document) if isinstance(document, str) else document
    parts = [_entries(document if at == "$" else F.try_variant_get(document, at, "variant"), prefix)]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            parts.append(_fields(document, f.dataType, f"{prefix}{f.name}.", f"{at}['{f.name}']"))
    return F.concat(*parts)


def _named(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """Paths the schema names, and their kinds."""
    found = []
    for f in schema.fields:
        found.append((f"{prefix}{f.name}", f.dataType.typeName().replace("long", "bigint")))
        if isinstance(f.dataType, T.StructType):
            found += _named(f.dataType, f"{prefix}{f.name}.")
    return found


def _expected(fields: str, schema: T.StructType) -> Column:
    """Named paths that are not among the fields of a document, as far as their struct is there."""
    names = F.transform(fields, lambda f: f["field"])
    objects = F.transform(F.filter(fields, lambda f: json_type(f["value"]) == "object"), lambda f: f["field"])
    wanted = [F.when(F.lit("." not in path) | F.array_contains(objects, path.rpartition(".")[0]), F.lit(path)) for path, _ in _named(schema)]
    return F.array_except(F.array_compact(F.array(*wanted)), names)
