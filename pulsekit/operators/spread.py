"""Spread generated rows over every core.

Replicate generators (simulations, draws, bootstrap replicates) start from
a handful of group-level rows, so the explode would run in one task.  A
hash repartition to the default parallelism (an explicit count, which AQE
does not coalesce back) puts the generated work on all executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parallelism(df: DataFrame) -> int:
    spark = df.sparkSession
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame, *cols: str, factor: int = 1) -> DataFrame:
    """Hash-repartition on ``cols`` (round-robin without ``cols``; use that when
    the input is already hash-partitioned on the same key, where a hash
    repartition would be dropped as redundant and AQE would coalesce it)."""
    n = max(_parallelism(df) * factor, 1)
    return df.repartition(n, *cols) if cols else df.repartition(n)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the cluster's shared checkpoint folder and read
    it back, cutting the lineage.

    Used for small derived frames (one row per user or per distinct value)
    that several later stages read: they are computed once instead of the
    event log being re-scanned for each use, and a lost executor re-reads
    the checkpoint rather than recomputing from the raw logs.
    """
    from pulsekit.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)



#: Rows of a frame that goes to every task.
FEW_ROWS = 100_000


def broadcast_if_few(df: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """``df`` with the hint to broadcast it if it has at most ``rows`` rows; a
    larger one is left to the join's own choice.  Counts the frame once."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
