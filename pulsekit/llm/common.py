"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.session import shared_path, ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def job_dir(spark: SparkSession, name: str) -> str:
    """A new folder for this job's tables and files, in the shared folder the
    cluster names in ``spark.checkpoint.dir``."""
    ship(spark)
    return shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table below ``folder`` and read it back: a cut
    in the lineage that survives the loss of executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns an operator reads, whatever else (and however
    named) the table carries; a null text is the empty text."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def pieces(batch: pa.RecordBatch, max_chars: int = 4_000_000, column: str = "text"
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_chars`` bytes of text (one
    longer row makes its own run), so that memory follows the run, not the
    batch."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pa.compute.binary_length(col).fill_null(0), dtype=np.int64)
    run = np.cumsum(size) // max_chars
    cuts = np.flatnonzero(np.diff(run)) + 1
    lo = 0
    for hi in [*cuts.tolist(), batch.num_rows]:
        if hi > lo:
            yield batch.slice(lo, hi - lo)
            lo = hi


def release() -> None:
    """Give freed memory back at the end of a task: a worker lives on, and other
    processes of its executor share the limit."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:                                 # not glibc
        pass


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every (start, length) range, in order."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


#: Stands for a null doc_id where rows are matched.
NULL_ID = -(1 << 63)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(docs: DataFrame, kept: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs``, with their columns, whose document and text are in
    ``kept`` (doc_id, text_key); ``once``: one of the rows that share both."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = [free_name(docs, "__llm_id"), free_name(docs, "__llm_text")]
    keyed = (docs.withColumn(keys[0], F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
             .withColumn(keys[1], F.xxhash64(text)))
    wanted = kept.select(F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias(keys[0]),
                         F.col("text_key").alias(keys[1])).distinct()
    found = keyed.join(wanted, keys, "left_semi")
    if once:            # joined by the same keys: no row moves again
        found = found.dropDuplicates(keys)
    return found.select(*docs.columns)
