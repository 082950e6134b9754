"""The per-dimension daily mart: a catalog table over Parquet files,
partitioned by event_date.

Writing a day replaces that day, also when it has become empty: a re-run leaves
what one run leaves.  Rows of other days are refused.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MART_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("dimension_value", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("messages_received", T.LongType()),
    T.StructField("messages_sent", T.LongType()),
    T.StructField("users_received", T.LongType()),
    T.StructField("users_sent", T.LongType()),
])


def create_mart_table(spark: SparkSession, name: str, path: str) -> None:
    """Register the mart as a catalog table over ``path`` if absent."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MART_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
        f"PARTITIONED BY (event_date) LOCATION '{path}'"
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    spark.sql(f"MSCK REPAIR TABLE {name}")      # days that the folder already holds


def write_mart(mart: DataFrame, name: str, day: dt.date) -> None:
    """Replace ``day`` in the table ``name`` by ``mart``, sorted by dimension."""
    spark = mart.sparkSession
    rows = mart.select(*[F.col(f.name).cast(f.dataType) for f in MART_SCHEMA.fields if f.name != "event_date"],
                       F.when(F.col("event_date") == F.lit(day), F.col("event_date"))
                       .otherwise(F.raise_error(F.lit(f"a row of another day than {day}")).cast("date"))
                       .alias("event_date"))
    view = f"_rows_of_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    columns = ", ".join(f.name for f in MART_SCHEMA.fields if f.name != "event_date")
    try:
        # a static partition is replaced as a whole, whether or not rows come
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (event_date = DATE '{day}') "
                  f"SELECT {columns} FROM {view} WHERE event_date IS NOT NULL SORT BY dimension, dimension_value")
    finally:
        spark.catalog.dropTempView(view)


def read_mart(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*[f.name for f in MART_SCHEMA.fields])
