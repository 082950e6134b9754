"""Seeded resampling: A/A simulation, random-pair P(A > B), Poisson bootstrap.

Randomness is a pure function of (seed, replicate, ...) through md5, so
every job is repeatable, survives task retries unchanged, and can be
reproduced by any SQL engine.

A/A simulation: users are numbered 0..n-1 inside their group (distributed
prefix count).  Each (simulation, group) row has a keyed permutation of 0..n-1
(``functions.permutation``), and the images of 0..k-1 are its sample without
replacement.  A group smaller than ``k`` is an error.
Only the sampled indices are joined to the users -- simulations are never
crossed with users.

Poisson bootstrap: users with the same (group, likes, views) are one cell, and
the sum of their Poisson(1) weights is one Poisson(m) draw for m users, of a few
uniforms for any m (``functions.poisson``).  Work and shuffle follow the number of
distinct cells, not of users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.hashing import uniform01
from pulsekit.functions.permutation import ROUNDS, round_keys, with_permuted
from pulsekit.functions.poisson import parts_of, poisson_part, quoted
from pulsekit.functions.stats import welch_columns
from pulsekit.operators.prefix import dense_index
from pulsekit.operators.spread import spread


def indexed_users(df: DataFrame, value_col: str, groups, group_col: str = "exp_group") -> DataFrame:
    """(group, idx, value) with idx = position of user_id in its group."""
    u = df.filter(F.col(group_col).isin(*groups) & F.col(value_col).isNotNull()) \
          .select(group_col, "user_id", F.col(value_col).alias("value"))
    return dense_index(u, [group_col], "user_id")


def aa_simulation(df: DataFrame, value_col: str, groups=(2, 3), n_sims: int = 10000, k: int = 500,
                  seed: int = 0, group_col: str = "exp_group", replace: bool = False,
                  most_share: float | None = None) -> DataFrame:
    """One row per simulation: sample sizes, means, Welch t, df and p of two samples
    of ``k`` users drawn without replacement from each group (``replace=True``: with
    replacement, a bootstrap-style A/A check).  A group of fewer than ``k`` users is
    an error; with ``most_share`` the samples are instead at most that share of the
    smaller group (rounded down)."""
    a, b = groups
    users = indexed_users(df, value_col, groups, group_col)
    n = F.col("n")
    sizes = users.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    draws = F.lit(k).cast("long")
    if most_share is not None:
        # two rows: every group gets the size that the smaller allows
        least = F.min("n").over(Window.partitionBy(F.lit(0)))
        draws = F.least(draws, F.floor(least * F.lit(most_share)))
    sizes = sizes.select(group_col, "n", draws.alias("k"))
    if not replace:
        small = F.raise_error(F.concat(F.lit(f"an A/A sample of {k} from a group of "), n.cast("string"))).cast("long")
        sizes = sizes.withColumn("n", F.when(n >= F.col("k"), n).otherwise(small))
    sims = spread(sizes.select(group_col, "n", "k", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(n_sims - 1).cast("long"))).alias("sim")), group_col, "sim")
    if not replace:        # a permutation of the group's users for each (sim, group)
        keys = [f"_key{r}" for r in range(ROUNDS)]
        sims = sims.select("*", *[c.alias(x) for x, c in zip(keys, round_keys(F.lit(seed), F.col("sim"), F.col(group_col)))])
    # draws j = 0..k-1 per (sim, group): one row each
    raw = sims.select("*", F.explode(F.expr("sequence(0L, k - 1)")).alias("j")).where("k > 0")
    if replace:
        drawn = raw.select(group_col, "sim", "k", F.floor(
            uniform01(F.lit(seed), F.col("sim"), F.col(group_col), F.col("j") + 1) * n).cast("long").alias("idx"))
    else:
        drawn = with_permuted(raw, "j", "n", keys, "idx").select(group_col, "sim", "k", "idx")
    picked = drawn.join(users.select(group_col, "idx", "value"), [group_col, "idx"])
    per = picked.groupBy(group_col, "sim").agg(
        F.count(F.lit(1)).alias("cnt"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))
    def side(g, col):
        return F.max(F.when(F.col(group_col) == F.lit(g), F.col(col)))

    wide = spread(per.groupBy("sim").agg(
        side(a, "cnt").alias("n_a"), side(b, "cnt").alias("n_b"),
        side(a, "mean").alias("mean_a"), side(b, "mean").alias("mean_b"),
        side(a, "var").alias("var_a"), side(b, "var").alias("var_b")))
    w = welch_columns(F.col("n_a").cast("double"), F.col("mean_a"), F.col("var_a"),
                      F.col("n_b").cast("double"), F.col("mean_b"), F.col("var_b"))
    return wide.select("sim", "n_a", "n_b", "mean_a", "mean_b", *[c.alias(k_) for k_, c in w.items()])


def false_positive_rate(sims: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Share of all simulations with p <= alpha, and how many have no p."""
    significant = F.count_if(F.col("p_value") <= F.lit(alpha))
    return sims.agg(
        F.count(F.lit(1)).alias("n_sims"),
        significant.alias("n_significant"),
        F.count_if(F.col("p_value").isNull()).alias("n_undefined"),
        F.try_divide(significant.cast("double"), F.count(F.lit(1)).cast("double")).alias("share"))


def prob_a_gt_b_mc(df: DataFrame, value_col: str, a, b, n_draws: int = 10000, seed: int = 0,
                   group_col: str = "exp_group") -> DataFrame:
    """Share of ``n_draws`` random (a-user, b-user) pairs, drawn with
    replacement, where a's value is larger."""
    users = indexed_users(df, value_col, (a, b), group_col)
    sizes = users.agg(F.count_if(F.col(group_col) == F.lit(a)).alias("n_a"),
                      F.count_if(F.col(group_col) == F.lit(b)).alias("n_b"))
    draws = sizes.select("n_a", "n_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_draws - 1).cast("long"))).alias("draw"))
    draws = spread(draws, "draw")
    draws = draws.select(
        "draw",
        F.floor(uniform01(F.lit(seed), F.lit("a"), F.col("draw")) * F.col("n_a")).cast("long").alias("ia"),
        F.floor(uniform01(F.lit(seed), F.lit("b"), F.col("draw")) * F.col("n_b")).cast("long").alias("ib"))
    ua = users.filter(F.col(group_col) == F.lit(a)).select(F.col("idx").alias("ia"), F.col("value").alias("va"))
    ub = users.filter(F.col(group_col) == F.lit(b)).select(F.col("idx").alias("ib"), F.col("value").alias("vb"))
    j = draws.join(ua, "ia").join(ub, "ib")
    return j.agg(
        F.count(F.lit(1)).alias("n_draws"),
        F.count_if(F.col("va") > F.col("vb")).alias("a_gt_b"),
        F.try_divide(F.count_if(F.col("va") > F.col("vb")).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("share"))


def poisson_weights(cells: DataFrame, keys: list[str], n_reps: int, seed: int, m: str = "m") -> DataFrame:
    """(rep, *keys, m, part, weight): for each replicate and cell the parts of a
    Poisson(m) draw, to be added up.  ``keys`` name a cell; a cell has one part, or
    the powers of two in an m below SMALL."""
    cells = cells.select(*keys, F.col(m).cast("long").alias("m"))
    parts = spread(cells.select("*", F.explode(parts_of("m")).alias("part")), *keys, "part")
    reps = parts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_reps - 1).cast("long"))).alias("rep"))
    at = [F.lit(seed), F.col("rep"), *[F.col(k) for k in keys]]
    reps = reps.withColumn("u", uniform01(*at, F.col("part"), F.lit(0)))
    weight = poisson_part("part", "m", "u", [str(seed), "rep", *map(quoted, keys), "'m'"])
    return reps.select("rep", *keys, "m", "part", weight.alias("weight"))


def poisson_bootstrap(users: DataFrame, groups=(1, 2), n_bootstrap: int = 2000, seed: int = 0,
                      group_col: str = "exp_group") -> DataFrame:
    """Per (replicate, group): Poisson(1)-weighted likes, views and global CTR.
    The weight of m users in one cell is one Poisson(m) draw, of a few uniforms
    whatever m is, so the work follows the distinct cells."""
    cells = (users.filter(F.col(group_col).isin(*groups)).groupBy(group_col, "likes", "views")
             .agg(F.count(F.lit(1)).alias("m")))
    w = F.col("weight")
    weighted = (poisson_weights(cells, [group_col, "likes", "views"], n_bootstrap, seed)
                .select(group_col, "rep", (w * F.col("likes")).alias("wl"), (w * F.col("views")).alias("wv")))
    agg = weighted.groupBy("rep", group_col).agg(F.sum("wl").alias("likes"), F.sum("wv").alias("views"))
    return agg.withColumn("global_ctr", F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")))


def bootstrap_diffs(boot: DataFrame, a, b, group_col: str = "exp_group") -> DataFrame:
    """(rep, diff): ctr_a - ctr_b per replicate."""
    per = boot.groupBy("rep").agg(
        F.max(F.when(F.col(group_col) == F.lit(a), F.col("global_ctr"))).alias("ctr_a"),
        F.max(F.when(F.col(group_col) == F.lit(b), F.col("global_ctr"))).alias("ctr_b"))
    return per.select("rep", (F.col("ctr_a") - F.col("ctr_b")).alias("diff"))


def bootstrap_diff(boot: DataFrame, a, b, group_col: str = "exp_group") -> DataFrame:
    """Distribution summary of ctr_a - ctr_b over replicates."""
    d = bootstrap_diffs(boot, a, b, group_col)
    return d.agg(
        F.count("diff").alias("n_reps"),
        F.avg("diff").alias("mean_diff"),
        F.try_divide(F.count_if(F.col("diff") > 0).cast("double"),
                     F.count("diff").cast("double")).alias("share_positive"),
        F.percentile("diff", F.lit(0.025)).alias("q025"),
        F.percentile("diff", F.lit(0.975)).alias("q975"))
