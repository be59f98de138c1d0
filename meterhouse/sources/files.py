"""Event files: landing, discovery, schema widening and rescue of unknown fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.operators.shape import json_ready
from meterhouse.sources.tables import path_exists

RESCUED = "_rescued_data"
ADD_COLUMNS, RESCUE = "addNewColumns", "rescue"


class SchemaWidened(Exception):
    """New fields were recorded; the next run reads them."""


def land_ndjson(df: DataFrame, root: str, table: str, key: str) -> str | None:
    """Writes a pulled batch as JSON lines, in a folder named by its first and last key.

    The same range lands in the same folder again. An empty batch lands nothing.
    """
    first, last = df.agg(F.min(key), F.max(key)).first()
    if first is None:
        return None
    path = f"{root}/{table}/{table}_{first:012d}_{last:012d}"
    json_ready(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def stream_ndjson(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Stream over landed folders: each run reads the files it has not seen."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same discovery with each JSON line left as text, for ``rescue_columns``."""
    return spark.readStream.option("recursiveFileLookup", "true").text(path)


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.option("recursiveFileLookup", "true").json(path).schema


def merge_schemas(known: T.StructType, found: T.StructType) -> T.StructType:
    """Known fields keep name, type and place; unknown ones follow."""
    have = set(known.names)
    return T.StructType(list(known.fields) + [f for f in found.fields if f.name not in have])


def evolve_schema(
    spark: SparkSession, path: str, known: T.StructType | None, mode: str = ADD_COLUMNS
) -> T.StructType:
    """The schema to read ``path`` with: widened, or in ``rescue`` mode as it was."""
    if known is None:
        return infer_schema(spark, path)
    return known if mode == RESCUE else merge_schemas(known, infer_schema(spark, path))


def recorded_schema(
    spark: SparkSession, path: str, record: str, mode: str = ADD_COLUMNS
) -> T.StructType:
    """Schema recorded for a landing path; the first run infers it.

    When files bring new fields in ``addNewColumns`` mode, the wider schema is recorded and
    ``SchemaWidened`` raised, so that no run changes its schema half way. The next run goes through.
    """
    import json

    known = None
    if path_exists(spark, record):
        known = T.StructType.fromJson(json.loads(spark.read.text(record).first()[0]))
    schema = evolve_schema(spark, path, known, mode)
    if known is None or schema != known:
        line = spark.createDataFrame([(schema.json(),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(record)
    if known is not None and schema != known:
        new = [n for n in schema.names if n not in known.names]
        raise SchemaWidened(f"new fields recorded: {', '.join(new)}")
    return schema


def rescue_columns(lines: DataFrame, known: T.StructType, column: str = "value") -> DataFrame:
    """Known fields as columns; unknown fields, and values of a wrong type, as JSON beside them."""
    names = F.array(*[F.lit(n) for n in known.names])
    parsed = lines.select(
        *[c for c in lines.columns if c != column],
        F.from_json(column, known).alias("_row"),
        F.from_json(column, "map<string,string>").alias("_all"),
    )
    # parsed to NULL although the text holds a value
    lost = F.filter(
        F.array(*[F.when(F.col("_row")[n].isNull(), F.lit(n)) for n in known.names]),
        lambda n: n.isNotNull(),
    )
    extra = F.map_filter(
        "_all",
        lambda k, v: v.isNotNull() & (~F.array_contains(names, k) | F.array_contains(lost, k)),
    )
    return parsed.select(
        *[c for c in lines.columns if c != column],
        "_row.*",
        F.when(F.size(extra) > 0, F.to_json(extra)).alias(RESCUED),
    )
