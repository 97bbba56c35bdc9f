"""Writers and stored intermediate results."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def _there(spark: SparkSession, path: str, *names: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def materialize(spark: SparkSession, build: Callable[[], DataFrame], path: str, force: bool = False) -> DataFrame:
    """The stored table at ``path`` if there is a finished one, else compute, store and read it back.

    A folder without the marker of a finished write is never overwritten unless ``force`` is set: it may be a write
    under way, or something else.
    """
    if not force and _there(spark, path, "_SUCCESS"):
        return spark.read.parquet(path)
    if not force and _there(spark, path):
        raise FileExistsError(f"{path} is no finished table; look at it, then use force")
    build().write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True, crlf: bool = True) -> None:
    """Delimited text, names and values in quotes, rows ended by CRLF."""
    end = "\r\n" if crlf else "\n"
    df.write.mode("overwrite").options(sep=sep, header=header, lineSep=end, quoteAll=True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def jdbc_frame(df: DataFrame) -> DataFrame:
    """Upper-case names, timestamps as dates: the shape tables get in a database."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    dated = df.withColumns({c: F.col(c).cast("date") for c in times}) if times else df
    return dated.toDF(*[c.upper() for c in dated.columns])


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], replace: bool = False) -> None:
    jdbc_frame(df).write.jdbc(url, table, mode="overwrite" if replace else "append", properties=dict(properties))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
