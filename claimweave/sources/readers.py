"""Readers. Schemas are declared, not inferred, so a read never scans the data twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.frames import lower_columns


def read_parquet_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_lookup_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    select: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    if select is not None:
        df = df.select(*select)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = "|", header: bool = True, **options: object
) -> DataFrame:
    return lower_columns(spark.read.schema(schema).options(**options).csv(path, sep=sep, header=header))


def read_header_detail(
    spark: SparkSession,
    path: str,
    header_columns: Sequence[str],
    detail_columns: Sequence[str],
    header_type: str = "H",
    sep: str = "|",
) -> DataFrame:
    """Files whose first record is the group header: every detail row carries its file's header.

    The record type tells headers from details, so nothing depends on line order. Headers are
    one row per file and meet their details on the file name.
    """
    escaped = "\\" + sep
    lines = spark.read.text(path).select(
        F.split("value", escaped, -1).alias("f"), F.input_file_name().alias("_file")
    )
    kind = F.col("f")[0]

    def fields(names: Sequence[str]) -> list:
        return [F.nullif(F.trim(F.get("f", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names, start=1)]

    head = lines.where(kind == header_type).select("_file", *fields(header_columns))
    body = lines.where((kind != header_type) & (F.size("f") > 1)).select("_file", *fields(detail_columns))
    return body.join(head, "_file", "left").drop("_file").select(*header_columns, *detail_columns)


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """XML files to one column per tag; records that cannot be read are skipped."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("mode", "DROPMALFORMED")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json_model_sample(spark: SparkSession, path: str) -> list[str]:
    """The feature columns of a stored sample, in the order they have in its first record."""
    first = spark.read.text(path).where(F.length(F.trim("value")) > 0).first()
    if first is None:
        return []
    keys = spark.range(1).select(F.json_object_keys(F.lit(first.value)).alias("k")).first().k
    return list(keys or [])


def read_jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str], **partitioning: object) -> DataFrame:
    """Result of a database query with lower-cased names.

    ``partitioning`` takes ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``; without them one task reads everything.
    """
    options = {"url": url, "dbtable": f"({query}) q", **properties, **partitioning}
    return lower_columns(spark.read.format("jdbc").options(**options).load())
