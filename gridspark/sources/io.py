"""Files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.geo import GEO_FIELDS, ensure_z, resolve_geometry, strip_z, unwrap_features
from gridspark.functions.scalars import sanitise
from gridspark.operators.query import query

# Record keys that are not data fields.
_RECORD_KEYS = ("id", "recordid", "size", "fields", "record_timestamp", "links")
EXPORT_FORMATS = ("csv", "json", "parquet")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON records, one per line, nested under ``fields`` or flat, or a mix of both.

    ``recordid`` becomes ``id``; a flat record without either gets ``"unknown"``. NaN and infinities
    become null and Feature wrappers are taken off geometry fields.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return flatten_records(reader.json(path))


def flatten_records(raw: DataFrame) -> DataFrame:
    """Bring nested and flat records to one row form: ``id`` and the data fields as columns."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    nested = types["fields"].fieldNames() if isinstance(types.get("fields"), T.StructType) else []
    flat = [c for c in raw.columns if c not in _RECORD_KEYS]
    ids = [F.col(c).cast("string") for c in ("id", "recordid") if c in types]
    is_nested = F.col("fields").isNotNull() if nested else F.lit(False)
    found = F.coalesce(*ids) if ids else F.lit(None).cast("string")
    out = [F.when(is_nested, found).otherwise(F.coalesce(found, F.lit("unknown"))).alias("id")]
    for name in dict.fromkeys([*nested, *flat]):
        inner, outer = F.col(f"fields.`{name}`"), F.col(f"`{name}`")
        if name not in flat:
            value = inner
        elif name not in nested:
            value = F.when(~is_nested, outer)
        else:
            value = F.when(is_nested, inner).otherwise(outer)
        out.append(value.alias(name))
    return unwrap_features(sanitise(raw.select(*out)))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ";") -> DataFrame:
    """Delimited text with a header line; without a schema all columns are text."""
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def export(df: DataFrame, path: str, format: str = "csv", limit: int | None = None, offset: int | None = None, mode: str = "errorifexists", **params) -> None:
    """Write the rows that the query parameters leave. A limit or offset of zero means none."""
    if format not in EXPORT_FORMATS:
        raise ValueError(f"cannot write {format!r}; formats are {', '.join(EXPORT_FORMATS)}")
    writer = query(df, limit=limit or None, offset=offset or 0, **params).write.mode(mode)
    if format == "csv":
        writer.option("header", True).option("sep", ";").csv(path)
    elif format == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def geojson_features(df: DataFrame, dimensions: str = "raw") -> DataFrame:
    """One GeoJSON Feature per row, as text in ``value``."""
    if dimensions not in ("raw", "2d", "3d"):
        raise ValueError(f"dimensions {dimensions!r} are none of ('raw', '2d', '3d')")
    geometry = resolve_geometry(df)
    if dimensions != "raw":
        geometry = (strip_z if dimensions == "2d" else ensure_z)(geometry)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in GEO_FIELDS]
    properties = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")
    parts = [
        F.lit('{"type":"Feature","geometry":'),
        F.coalesce(geometry, F.lit("null")),
        F.lit(',"properties":'),
        properties,
        F.lit("}"),
    ]
    return df.select(F.concat(*parts).alias("value"))


def export_geojson(df: DataFrame, path: str, dimensions: str = "raw", mode: str = "errorifexists", **params) -> None:
    """Write newline-delimited GeoJSON Features, many files in parallel."""
    geojson_features(query(df, **params), dimensions).write.mode(mode).text(path)
