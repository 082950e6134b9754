"""User-level experiment frames and per-group summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import day_range, safe_div
from pulsekit.functions.hashing import ab_split


def user_ctr(feed: DataFrame, first_day: dt.date, last_day: dt.date,
             groups: tuple | list | None = None, group_col: str = "exp_group") -> DataFrame:
    """(exp_group, user_id, likes, views, ctr) over whole days; ctr NULL
    when a user has no views."""
    f = feed.filter(day_range(feed, "time", first_day, last_day))
    if groups is not None:
        f = f.filter(F.col(group_col).isin(*groups))
    agg = f.groupBy(group_col, "user_id").agg(
        F.count_if(F.col("action") == "like").alias("likes"),
        F.count_if(F.col("action") == "view").alias("views"),
    )
    return agg.withColumn("ctr", safe_div(F.col("likes"), F.col("views")))


def user_split(feed: DataFrame, first_day: dt.date, last_day: dt.date,
               salt: str = "exp_mess_1", n_groups: int = 5) -> DataFrame:
    """Distinct users active in the window with their salted hash group."""
    f = feed.filter(day_range(feed, "time", first_day, last_day))
    users = f.select("user_id").distinct()
    return users.withColumn("hash_group", ab_split("user_id", salt, n_groups))


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("hash_group").agg(F.count_distinct("user_id").alias("users"))


def group_counts(df: DataFrame, group_col: str = "exp_group",
                 cols: tuple = ("user_id", "likes", "views", "ctr")) -> DataFrame:
    """Non-NULL count of each column per group (``df.groupby(g).count()``)."""
    return df.groupBy(group_col).agg(*[F.count(c).alias(f"n_{c}") for c in cols])


def global_ctr(df: DataFrame, group_col: str = "exp_group") -> DataFrame:
    """Per group: total likes, total views, their ratio."""
    agg = df.groupBy(group_col).agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    return agg.withColumn("global_ctr", safe_div(F.col("likes"), F.col("views")))


def moments(df: DataFrame, value_col: str, group_col: str = "exp_group") -> DataFrame:
    """n, mean and sample variance (ddof 1) of a value per group."""
    return df.groupBy(group_col).agg(
        F.count(value_col).alias("n"),
        F.avg(value_col).alias("mean"),
        F.var_samp(value_col).alias("var"),
    )
