"""Experiment read-outs: split check, A/A simulation, A/B tests on raw,
smoothed, bucketed and linearized metrics, bootstrap and histograms."""

from __future__ import annotations

from pulsekit.oracle_sql import (
    norm_p, poisson_any, r6 as s6, split as s_split, uniform as s_uniform, welch_sql, with_fixture,
    xxh64_of_longs,
)
from pyspark.sql import functions as F

from pulsekit.functions.columns import day_range
from pulsekit.operators.experiment import histogram as hist
from pulsekit.operators.experiment import resample, transforms, two_sample, user_metrics as um
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.plans.catalog import r6, register
from pulsekit.plans.daily import days_where
from pulsekit.operators.spread import materialize
from pulsekit.sources import load_fixture_tables

EXP = days_where(P.exp_start, P.exp_end)
AA, AB = P.aa_groups, P.ab_groups
SEED = P.seed


def _users(spark, sf_dir, groups=None, reuse: bool = False):
    """User-level frame of the experiment window.  ``reuse``: the read-out
    reads it more than once, so it is materialized (one row per user) instead
    of re-aggregating the event log for each use."""
    fd, _ = load_fixture_tables(spark, sf_dir)
    users = um.user_ctr(fd, P.exp_start, P.exp_end, groups)
    return materialize(users) if reuse else users


def _in(groups) -> str:
    return ", ".join(str(g) for g in groups)


def recursive(*ctes: str) -> str:
    return with_fixture(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


UC = f"""
uc AS (
    SELECT exp_group, user_id,
           count(CASE WHEN action = 'like' THEN 1 END) AS likes,
           count(CASE WHEN action = 'view' THEN 1 END) AS views,
           CAST(count(CASE WHEN action = 'like' THEN 1 END) AS DOUBLE)
             / NULLIF(CAST(count(CASE WHEN action = 'view' THEN 1 END) AS DOUBLE), 0) AS ctr
    FROM feed_actions WHERE {EXP}
    GROUP BY exp_group, user_id)"""

GCTR = """
gc AS (SELECT exp_group, CAST(sum(likes) AS DOUBLE) / NULLIF(CAST(sum(views) AS DOUBLE), 0) AS global_ctr
       FROM uc GROUP BY exp_group)"""

SMOOTH = GCTR + f""",
sm AS (SELECT uc.*, (uc.likes + {P.smooth_alpha!r} * gc.global_ctr) / (uc.views + {P.smooth_alpha!r}) AS smoothed_ctr
       FROM uc JOIN gc USING (exp_group) WHERE exp_group IN ({_in(AB)}))"""

CONTROL_ROWS = ", ".join(f"({g}, {c})" for g, c in sorted(P.lin_control.items()))
LIN = GCTR + f""",
cm AS (SELECT * FROM (VALUES {CONTROL_ROWS}) t(exp_group, control_group)),
ll AS (SELECT uc.*, uc.likes - gc.global_ctr * uc.views AS lin_likes
       FROM uc JOIN cm USING (exp_group) JOIN gc ON gc.exp_group = cm.control_group)"""

def _buckets(bucketed: str) -> str:
    """Ratio and exact quantile of every (group, bucket) of the users ``bucketed``."""
    return f"""
ub AS ({bucketed}),
bc AS (SELECT exp_group, bucket,
              CAST(sum(likes) AS DOUBLE) / NULLIF(CAST(sum(views) AS DOUBLE), 0) AS bucket_ctr,
              count(ctr) AS n
       FROM ub GROUP BY exp_group, bucket),
rk AS (SELECT exp_group, bucket, ctr,
              row_number() OVER (PARTITION BY exp_group, bucket ORDER BY ctr) - 1 AS pos
       FROM ub WHERE ctr IS NOT NULL),
bq AS (SELECT bc.exp_group, bc.bucket, bc.bucket_ctr, rk.ctr AS ctr9
       FROM bc LEFT JOIN rk ON rk.exp_group = bc.exp_group AND rk.bucket = bc.bucket
        AND rk.pos = least(floor({P.bucket_quantile!r} * bc.n), bc.n - 1))"""


BUCKETS = _buckets(f"""SELECT *, {s_split('user_id', None, P.n_buckets)} AS bucket FROM uc
       WHERE exp_group IN ({_in(AB)})""")
XXH_BUCKETS = f"xh AS ({xxh64_of_longs('uc', 'user_id')})," + _buckets(f"""
       SELECT uc.*, CAST(xh.h % {P.n_buckets} AS INTEGER) AS bucket FROM uc JOIN xh USING (user_id)
       WHERE exp_group IN ({_in(AB)})""")


# ------------------------------------------------------------ split and user frames
@register("user_ctr", with_fixture(UC, f"SELECT exp_group, user_id, likes, views, {s6('ctr')} AS ctr FROM uc"))
def q_user_ctr(spark, sf_dir):
    return r6(_users(spark, sf_dir))


@register("user_split", with_fixture(f"""
    SELECT DISTINCT user_id, {s_split('user_id', P.split_salt, P.split_groups)} AS hash_group
    FROM feed_actions WHERE {EXP}"""))
def q_user_split(spark, sf_dir):
    fd, _ = load_fixture_tables(spark, sf_dir)
    return um.user_split(fd, P.exp_start, P.exp_end, P.split_salt, P.split_groups)


@register("split_sizes", with_fixture(f"""
    SELECT {s_split('user_id', P.split_salt, P.split_groups)} AS hash_group, count(DISTINCT user_id) AS users
    FROM feed_actions WHERE {EXP} GROUP BY 1"""))
def q_split_sizes(spark, sf_dir):
    fd, _ = load_fixture_tables(spark, sf_dir)
    return um.split_sizes(um.user_split(fd, P.exp_start, P.exp_end, P.split_salt, P.split_groups))


@register("group_counts", with_fixture(UC, f"""
    SELECT exp_group, count(user_id) AS n_user_id, count(likes) AS n_likes, count(views) AS n_views,
           count(ctr) AS n_ctr
    FROM uc WHERE exp_group IN ({_in(AA)}) GROUP BY exp_group"""))
def q_group_counts(spark, sf_dir):
    return um.group_counts(_users(spark, sf_dir, AA))


@register("global_ctr", with_fixture(UC, f"""
    SELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
           {s6('CAST(sum(likes) AS DOUBLE) / NULLIF(CAST(sum(views) AS DOUBLE), 0)')} AS global_ctr
    FROM uc GROUP BY exp_group"""))
def q_global_ctr(spark, sf_dir):
    return r6(um.global_ctr(_users(spark, sf_dir)))


@register("ctr_moments", with_fixture(UC, f"""
    SELECT exp_group, count(ctr) AS n, {s6('avg(ctr)')} AS mean, {s6('var_samp(ctr)')} AS var
    FROM uc WHERE exp_group IN ({_in(AB)}) GROUP BY exp_group"""))
def q_ctr_moments(spark, sf_dir):
    return r6(um.moments(_users(spark, sf_dir, AB), "ctr"))


@register("smoothed_ctr", with_fixture(UC, SMOOTH, f"""
    SELECT exp_group, user_id, likes, views, {s6('ctr')} AS ctr, {s6('smoothed_ctr')} AS smoothed_ctr FROM sm"""))
def q_smoothed_ctr(spark, sf_dir):
    return r6(transforms.smoothed_ctr(_users(spark, sf_dir, AB, reuse=True), P.smooth_alpha))


@register("lin_likes", with_fixture(UC, LIN, f"""
    SELECT exp_group, user_id, likes, views, {s6('ctr')} AS ctr, {s6('lin_likes')} AS lin_likes FROM ll"""))
def q_lin_likes(spark, sf_dir):
    return r6(transforms.lin_likes(_users(spark, sf_dir, reuse=True), P.lin_control))


@register("bucket_ctr", with_fixture(UC, BUCKETS, f"""
    SELECT exp_group, bucket, {s6('bucket_ctr')} AS bucket_ctr, {s6('ctr9')} AS ctr9 FROM bq"""))
def q_bucket_ctr(spark, sf_dir):
    return r6(transforms.bucket_ctr(_users(spark, sf_dir, AB, reuse=True), P.n_buckets, P.bucket_quantile, "md5"))


# ------------------------------------------------------------ Welch
def _welch_sql(src: str, value: str, pairs) -> str:
    rows = ", ".join(f"({a}, {b})" for a, b in pairs)
    w = welch_sql("a.n", "a.m", "a.v", "b.n", "b.m", "b.v")
    return f"""
mom AS (SELECT exp_group, count({value}) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {src} GROUP BY exp_group),
pr AS (SELECT * FROM (VALUES {rows}) t(group_a, group_b)),
wt AS (SELECT pr.group_a, pr.group_b,
              coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, a.m AS mean_a, b.m AS mean_b,
              a.v AS var_a, b.v AS var_b,
              {w['t_stat']} AS t_stat, {w['dof']} AS dof, {w['p_value']} AS p_value
       FROM pr LEFT JOIN mom a ON a.exp_group = pr.group_a LEFT JOIN mom b ON b.exp_group = pr.group_b)"""


WELCH_OUT = (f"SELECT group_a, group_b, n_a, n_b, {s6('mean_a')} AS mean_a, {s6('mean_b')} AS mean_b, "
             f"{s6('var_a')} AS var_a, {s6('var_b')} AS var_b, {s6('t_stat')} AS t_stat, "
             f"{s6('dof')} AS dof, {s6('p_value')} AS p_value FROM wt")


@register("welch_ctr", with_fixture(UC, _welch_sql("uc", "ctr", P.welch_pairs), WELCH_OUT))
def q_welch_ctr(spark, sf_dir):
    return r6(two_sample.welch_test(_users(spark, sf_dir), "ctr", P.welch_pairs))


@register("welch_smoothed", with_fixture(UC, SMOOTH, _welch_sql("sm", "smoothed_ctr", [AB]), WELCH_OUT))
def q_welch_smoothed(spark, sf_dir):
    sm = transforms.smoothed_ctr(_users(spark, sf_dir, AB, reuse=True), P.smooth_alpha)
    return r6(two_sample.welch_test(sm, "smoothed_ctr", [AB]))


@register("bucket_ctr_xxhash", with_fixture(UC, XXH_BUCKETS, f"""
    SELECT exp_group, bucket, {s6('bucket_ctr')} AS bucket_ctr, {s6('ctr9')} AS ctr9 FROM bq"""))
def q_bucket_ctr_xxhash(spark, sf_dir):
    return r6(transforms.bucket_ctr(_users(spark, sf_dir, AB, reuse=True), P.n_buckets, P.bucket_quantile, "xxh64"))


@register("welch_bucket", with_fixture(UC, BUCKETS, _welch_sql("bq", "bucket_ctr", [AB]), WELCH_OUT))
def q_welch_bucket(spark, sf_dir):
    b = transforms.bucket_ctr(_users(spark, sf_dir, AB, reuse=True), P.n_buckets, None, "md5")
    return r6(two_sample.welch_test(b, "bucket_ctr", [AB]))


@register("welch_lin_likes", with_fixture(UC, LIN, _welch_sql("ll", "lin_likes", P.lin_pairs), WELCH_OUT))
def q_welch_lin_likes(spark, sf_dir):
    ll = transforms.lin_likes(_users(spark, sf_dir, reuse=True), P.lin_control)
    return r6(two_sample.welch_test(ll, "lin_likes", P.lin_pairs))


# ------------------------------------------------------------ Mann-Whitney
def _mwu_sql(src: str, value: str, a: int, b: int) -> str:
    na, nb = "CAST(s.n_a AS DOUBLE)", "CAST(s.n_b AS DOUBLE)"
    u_a = f"(s.r_a - {na} * ({na} + 1.0) / 2.0)"
    u_b = f"({na} * {nb} - {u_a})"
    n = f"({na} + {nb})"
    sd = f"sqrt({na} * {nb} / 12.0 * (({n} + 1.0) - s.ties / ({n} * ({n} - 1.0))))"
    z = f"(CASE WHEN {sd} > 0 THEN (greatest({u_a}, {u_b}) - {na} * {nb} / 2.0 - 0.5) / {sd} END)"
    return f"""
dv AS (SELECT {value} AS value, count(CASE WHEN exp_group = {a} THEN 1 END) AS n_a,
              count(CASE WHEN exp_group = {b} THEN 1 END) AS n_b
       FROM {src} WHERE exp_group IN ({a}, {b}) AND {value} IS NOT NULL GROUP BY {value}),
rv AS (SELECT *, n_a + n_b AS n_all,
              coalesce(sum(n_a + n_b) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_all,
              coalesce(sum(n_b) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_b
       FROM dv),
s AS (SELECT sum(n_a) AS n_a, sum(n_b) AS n_b,
             sum(n_a * (before_all + (n_all + 1) / 2.0)) AS r_a,
             sum(CAST(n_all AS DOUBLE) * n_all * n_all - n_all) AS ties,
             sum(n_a * before_b) AS gt, sum(n_a * n_b) AS eq
      FROM rv),
mw AS (SELECT {a} AS group_a, {b} AS group_b, CAST(s.n_a AS BIGINT) AS n_a, CAST(s.n_b AS BIGINT) AS n_b,
              {u_a} AS u_a, {u_b} AS u_b, {z} AS z, {norm_p(z)} AS p_value, 'asymptotic' AS method,
              CAST(s.gt AS DOUBLE) / NULLIF({na} * {nb}, 0) AS prob_a_gt_b,
              CAST(s.eq AS DOUBLE) / NULLIF({na} * {nb}, 0) AS prob_a_eq_b
       FROM s)"""


MWU_OUT = (f"SELECT group_a, group_b, n_a, n_b, {s6('u_a')} AS u_a, {s6('u_b')} AS u_b, {s6('z')} AS z, "
           f"{s6('p_value')} AS p_value, method, {s6('prob_a_gt_b')} AS prob_a_gt_b, "
           f"{s6('prob_a_eq_b')} AS prob_a_eq_b FROM ex")
# few values without ties: in how many ways each sum of the ranks of the smaller sample
# comes about, one rank more at a time (ways: by number of ranks taken, then sum)
EXACT_SQL = """
few AS (SELECT CAST(least(n_a, n_b) AS BIGINT) AS k, CAST(n_a + n_b AS BIGINT) AS n,
               CAST(least(n_a, n_b) * (n_a + n_b) + 1 AS BIGINT) AS width
        FROM s WHERE ties = 0 AND least(n_a, n_b) BETWEEN 1 AND 8 AND greatest(n_a, n_b) <= 10000),
ways(r, w) AS (
    SELECT CAST(0 AS BIGINT), list_transform(range(0, (k + 1) * width), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0 END) FROM few
    UNION ALL
    SELECT r + 1, list_transform(range(0, (k + 1) * width), lambda i:
               w[i + 1] + CASE WHEN i >= width AND i % width > r THEN w[i - width - r] ELSE 0.0 END)
    FROM ways, few WHERE r < n),
last AS (SELECT k, list_slice(w, k * width + 1, (k + 1) * width) AS w FROM ways, few WHERE r = n),
ex AS (SELECT mw.* EXCLUDE (p_value, method),
              CASE WHEN k IS NULL THEN mw.p_value
                   ELSE least(1.0, 2.0 * list_sum(list_slice(w, 1, CAST(least(u_a, u_b) AS BIGINT) + k * (k + 1) // 2 + 1)) / list_sum(w))
              END AS p_value,
              CASE WHEN k IS NULL THEN 'asymptotic' ELSE 'exact' END AS method
       FROM mw LEFT JOIN last ON true)"""


def _mwu_all(*ctes: str) -> str:
    return recursive(*ctes, EXACT_SQL, MWU_OUT)


@register("mwu_ctr", _mwu_all(UC, _mwu_sql("uc", "ctr", *AB)))
def q_mwu_ctr(spark, sf_dir):
    return r6(two_sample.mann_whitney(_users(spark, sf_dir, AB), "ctr", *AB))


@register("prob_a_gt_b", with_fixture(UC, _mwu_sql("uc", "ctr", *AB), f"""
    SELECT group_a, group_b, {s6('prob_a_gt_b')} AS prob_a_gt_b, {s6('prob_a_eq_b')} AS prob_a_eq_b FROM mw"""))
def q_prob_a_gt_b(spark, sf_dir):
    m = two_sample.mann_whitney(_users(spark, sf_dir, AB), "ctr", *AB)
    return r6(m.select("group_a", "group_b", "prob_a_gt_b", "prob_a_eq_b"))


@register("mwu_smoothed", _mwu_all(UC, SMOOTH, _mwu_sql("sm", "smoothed_ctr", *AB)))
def q_mwu_smoothed(spark, sf_dir):
    sm = transforms.smoothed_ctr(_users(spark, sf_dir, AB, reuse=True), P.smooth_alpha)
    return r6(two_sample.mann_whitney(sm, "smoothed_ctr", *AB))


@register("mwu_bucket", _mwu_all(UC, BUCKETS, _mwu_sql("bq", "bucket_ctr", *AB)))
def q_mwu_bucket(spark, sf_dir):
    b = transforms.bucket_ctr(_users(spark, sf_dir, AB, reuse=True), P.n_buckets, None, "md5")
    return r6(two_sample.mann_whitney(b, "bucket_ctr", *AB))


WEEKDAYS = f"""
wd AS (SELECT exp_group, dayofweek(time) + 1 AS weekday,
              CAST(count(CASE WHEN action = 'like' THEN 1 END) AS DOUBLE)
                / NULLIF(count(CASE WHEN action = 'view' THEN 1 END), 0) AS ctr
       FROM feed_actions WHERE {EXP} GROUP BY ALL)"""


@register("mwu_weekday", _mwu_all(WEEKDAYS, _mwu_sql("wd", "ctr", *AB)))
def q_mwu_weekday(spark, sf_dir):
    """Two groups' CTR by day of the week: samples of seven, so an exact p."""
    fd, _ = load_fixture_tables(spark, sf_dir)
    liked, viewed = (F.count_if(F.col("action") == x).cast("double") for x in ("like", "view"))
    days = (fd.filter(day_range(fd, "time", P.exp_start, P.exp_end)).groupBy("exp_group", F.dayofweek("time").alias("weekday"))
            .agg(F.try_divide(liked, viewed).alias("ctr")))
    return r6(two_sample.mann_whitney(days, "ctr", *AB))


# ------------------------------------------------------------ histograms
def _hist_sql(src: str, value: str, bins: int, by: str | None, lo: str, hi: str,
              by_data: bool = True) -> str:
    g = f"{by}, " if by else ""
    b = (f"CAST(CASE WHEN hi > lo THEN least(greatest(floor(({value} - lo) / (hi - lo) * {float(bins)!r}), 0), "
         f"{bins - 1}) ELSE 0 END AS INTEGER)")
    w = f"((hi - lo) / {float(bins)!r})"
    from_ = f" FROM {src} WHERE {value} IS NOT NULL" if by_data else ""
    return f"""
hr AS (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi{from_}),
hb AS (SELECT {g}{b} AS bin, lo, hi FROM {src}, hr WHERE {value} IS NOT NULL),
hist AS (SELECT {g}bin, {s6(f'lo + bin * {w}')} AS lower, {s6(f'lo + (bin + 1) * {w}')} AS upper,
                count(*) AS count
         FROM hb GROUP BY {g}bin, lo, hi)"""


@register("ctr_histogram", with_fixture(
    UC, f"uab AS (SELECT * FROM uc WHERE exp_group IN ({_in(AB)}))",
    _hist_sql("uab", "ctr", P.hist_bins, "exp_group", "min(ctr)", "max(ctr)"), "SELECT * FROM hist"))
def q_ctr_histogram(spark, sf_dir):
    return r6(hist.histogram(_users(spark, sf_dir, AB, reuse=True), "ctr", P.hist_bins, ("exp_group",)))


# ------------------------------------------------------------ seeded resampling
# an A/A run draws aa_sample_size (500) users of each group, or aa_most_share of the
# smaller group where that is less
N_SIMS, K = P.n_aa_sims, P.aa_sample_size
# users are numbered by (remainder of md5 by 2 ** 20, user_id)
IDX_ORDER = f"{s_split('user_id', None, 1048576)}, user_id"
A0, B0 = AA


def _aa_sql() -> str:
    """Runs draw by a permutation of the users' numbers: the rounds one by one, and
    again for what is not below n."""
    w = welch_sql("n_a", "mean_a", "var_a", "n_b", "mean_b", "var_b")
    h = [f"md5(concat_ws('-', {SEED}, sim, exp_group, {i}))" for i in (0, 1)]
    keys = ", ".join(f"('0x' || substr({h[r // 4]}, {8 * (r % 4) + 1}, 8))::BIGINT AS key{r}" for r in range(8))
    names = ", ".join(f"key{r}" for r in range(8))
    source = "(SELECT *, y // b AS l, y % b AS r FROM walk WHERE NOT started OR y >= n)"
    for r in range(8):
        own, other, size = ("l", "r", "a") if r % 2 == 0 else ("r", "l", "b")
        once = f"(({other} * 40503 + key{r}) % 2147483647)"
        source = f"(SELECT * REPLACE (({own} + ({once} * {once} + key{r}) % 2147483647) % {size} AS {own}) FROM {source})"
    return f"""
ui AS (SELECT exp_group, row_number() OVER (PARTITION BY exp_group ORDER BY {IDX_ORDER}) - 1 AS idx,
              ctr AS value
       FROM uc WHERE exp_group IN ({A0}, {B0}) AND ctr IS NOT NULL),
sz AS (SELECT exp_group, n, CAST(least({K}, floor(min(n) OVER () * {P.aa_most_share!r})) AS BIGINT) AS k,
              CAST(ceil(sqrt(n)) AS BIGINT) AS a
       FROM (SELECT exp_group, count(*) AS n FROM ui GROUP BY exp_group)),
walk(exp_group, sim, n, a, b, y, started, {names}) AS (
    SELECT exp_group, sim, n, a, (n + a - 1) // a, j, false, {keys}
    FROM (SELECT * FROM sz, range(0, {N_SIMS}) r(sim)), range(0, {K}) t(j) WHERE j < k
    UNION ALL
    SELECT exp_group, sim, n, a, b, l * b + r, true, {names} FROM {source}),
pk AS (SELECT exp_group, sim, CAST(y AS BIGINT) AS idx FROM walk WHERE started AND y < n),
per2 AS (SELECT pk.exp_group, pk.sim, count(*) AS cnt, avg(value) AS mean, var_samp(value) AS var
         FROM pk JOIN ui ON ui.exp_group = pk.exp_group AND ui.idx = pk.idx GROUP BY pk.exp_group, pk.sim),
wide AS (SELECT sim,
                max(CASE WHEN exp_group = {A0} THEN cnt END) AS n_a, max(CASE WHEN exp_group = {B0} THEN cnt END) AS n_b,
                max(CASE WHEN exp_group = {A0} THEN mean END) AS mean_a,
                max(CASE WHEN exp_group = {B0} THEN mean END) AS mean_b,
                max(CASE WHEN exp_group = {A0} THEN var END) AS var_a,
                max(CASE WHEN exp_group = {B0} THEN var END) AS var_b
         FROM per2 GROUP BY sim),
aa AS (SELECT sim, n_a, n_b, mean_a, mean_b, {w['t_stat']} AS t_stat, {w['dof']} AS dof,
              {w['p_value']} AS p_value FROM wide)"""


def _aa(spark, sf_dir):
    # one row per simulation; materialized so the p-value stage runs once
    # even when a read-out filters and projects it
    return materialize(resample.aa_simulation(_users(spark, sf_dir, AA), "ctr", AA, N_SIMS, K, SEED, most_share=P.aa_most_share))


@register("aa_simulation", recursive(UC, _aa_sql(), f"""
    SELECT sim, n_a, n_b, {s6('mean_a')} AS mean_a, {s6('mean_b')} AS mean_b, {s6('t_stat')} AS t_stat,
           {s6('dof')} AS dof, {s6('p_value')} AS p_value FROM aa"""))
def q_aa_simulation(spark, sf_dir):
    return r6(_aa(spark, sf_dir))


@register("aa_false_positive_rate", recursive(UC, _aa_sql(), f"""
    SELECT count(*) AS n_sims, count(CASE WHEN p_value <= {P.alpha!r} THEN 1 END) AS n_significant,
           count(*) - count(p_value) AS n_undefined,
           {s6(f"CAST(count(CASE WHEN p_value <= {P.alpha!r} THEN 1 END) AS DOUBLE) / NULLIF(count(*), 0)")}
             AS share
    FROM aa"""))
def q_aa_false_positive_rate(spark, sf_dir):
    return r6(resample.false_positive_rate(_aa(spark, sf_dir), P.alpha))


@register("p_value_histogram", recursive(
    UC, _aa_sql(), _hist_sql("aa", "p_value", P.hist_bins, None, "0.0", "1.0", by_data=False), "SELECT * FROM hist"))
def q_p_value_histogram(spark, sf_dir):
    return r6(hist.histogram(_aa(spark, sf_dir), "p_value", P.hist_bins, (), 0.0, 1.0))


@register("prob_a_gt_b_mc", with_fixture(UC, f"""
ui AS (SELECT exp_group, row_number() OVER (PARTITION BY exp_group ORDER BY {IDX_ORDER}) - 1 AS idx,
              ctr AS value
       FROM uc WHERE exp_group IN ({_in(AB)}) AND ctr IS NOT NULL),
sz AS (SELECT count(CASE WHEN exp_group = {AB[0]} THEN 1 END) AS n_a,
              count(CASE WHEN exp_group = {AB[1]} THEN 1 END) AS n_b FROM ui),
dr AS (SELECT r.draw,
              CAST(floor({s_uniform(str(SEED), "'a'", 'r.draw')} * n_a) AS BIGINT) AS ia,
              CAST(floor({s_uniform(str(SEED), "'b'", 'r.draw')} * n_b) AS BIGINT) AS ib
       FROM sz CROSS JOIN range(0, {P.n_pair_draws}) r(draw))""", f"""
    SELECT count(*) AS n_draws, count(CASE WHEN a.value > b.value THEN 1 END) AS a_gt_b,
           {s6('CAST(count(CASE WHEN a.value > b.value THEN 1 END) AS DOUBLE) / count(*)')} AS share
    FROM dr JOIN ui a ON a.exp_group = {AB[0]} AND a.idx = dr.ia
            JOIN ui b ON b.exp_group = {AB[1]} AND b.idx = dr.ib"""))
def q_prob_a_gt_b_mc(spark, sf_dir):
    return r6(resample.prob_a_gt_b_mc(_users(spark, sf_dir, AB), "ctr", *AB, P.n_pair_draws, SEED))


BOOT_SQL = f"""
cell AS (SELECT exp_group, likes, views, count(*) AS m FROM uc WHERE exp_group IN ({_in(AB)}) GROUP BY ALL),
bit AS (SELECT exp_group, likes, views, m, b AS part FROM cell, range(0, 4) r(b) WHERE m < 16 AND (m >> b) % 2 = 1
        UNION ALL
        SELECT exp_group, likes, views, m, -1 FROM cell WHERE m >= 16),
bu AS (SELECT r.rep, bit.*, {s_uniform(str(SEED), 'r.rep', 'exp_group', 'likes', 'views', 'part', '0')} AS u
       FROM bit, range(0, {P.n_bootstrap}) r(rep)),
bw AS (SELECT *, {poisson_any('m', 'u', 'part', str(SEED), 'rep', 'exp_group', 'likes', 'views', "'m'")} AS w FROM bu),
boot AS (SELECT rep, exp_group, CAST(sum(w * likes) AS BIGINT) AS likes, CAST(sum(w * views) AS BIGINT) AS views
         FROM bw GROUP BY rep, exp_group)"""


def _boot(spark, sf_dir, reuse: bool = False):
    boot = resample.poisson_bootstrap(_users(spark, sf_dir, AB), AB, P.n_bootstrap, SEED)
    # groups x replicates rows; materialized when read twice (histogram range + bins)
    return materialize(boot) if reuse else boot


@register("poisson_bootstrap", with_fixture(UC, BOOT_SQL, f"""
    SELECT rep, exp_group, likes, views,
           {s6('CAST(likes AS DOUBLE) / NULLIF(CAST(views AS DOUBLE), 0)')} AS global_ctr FROM boot"""))
def q_poisson_bootstrap(spark, sf_dir):
    return r6(_boot(spark, sf_dir))


@register("poisson_day_views", with_fixture(f"""
cell AS (SELECT exp_group, CAST(time AS DATE) AS day, count(*) AS m FROM feed_actions
         WHERE {EXP} AND action = 'view' GROUP BY ALL)""", f"""
bit AS (SELECT *, b AS part FROM cell, range(0, 4) r(b) WHERE m < 16 AND (m >> b) % 2 = 1
        UNION ALL SELECT *, NULL, -1 FROM cell WHERE m >= 16)""", f"""
bu AS (SELECT bit.*, r.rep, {s_uniform(str(SEED), 'r.rep', 'exp_group', 'day', 'part', '0')} AS u
       FROM bit, range(0, {P.n_day_reps}) r(rep))""", f"""
    SELECT rep, exp_group, day, m, CAST(sum({poisson_any('m', 'u', 'part', str(SEED), 'rep', 'exp_group', 'day', "'m'")}) AS BIGINT) AS views
    FROM bu GROUP BY rep, exp_group, day, m"""))
def q_poisson_day_views(spark, sf_dir):
    """Resampled views of each (group, day): Poisson draws around large counts."""
    fd, _ = load_fixture_tables(spark, sf_dir)
    days = (fd.filter(day_range(fd, "time", P.exp_start, P.exp_end) & (F.col("action") == "view"))
            .groupBy("exp_group", F.to_date("time").alias("day")).agg(F.count(F.lit(1)).alias("m")))
    drawn = resample.poisson_weights(days, ["exp_group", "day"], P.n_day_reps, SEED)
    return drawn.groupBy("rep", "exp_group", "day", "m").agg(F.sum("weight").alias("views"))


BD_SQL = f"""
bd AS (SELECT rep,
              max(CASE WHEN exp_group = {AB[0]} THEN CAST(likes AS DOUBLE) / NULLIF(CAST(views AS DOUBLE), 0) END)
            - max(CASE WHEN exp_group = {AB[1]} THEN CAST(likes AS DOUBLE) / NULLIF(CAST(views AS DOUBLE), 0) END)
              AS diff
       FROM boot GROUP BY rep)"""


@register("bootstrap_diff", with_fixture(UC, BOOT_SQL, BD_SQL, f"""
    SELECT count(diff) AS n_reps, {s6('avg(diff)')} AS mean_diff,
           {s6('CAST(count(CASE WHEN diff > 0 THEN 1 END) AS DOUBLE) / count(diff)')} AS share_positive,
           {s6('quantile_cont(diff, 0.025)')} AS q025, {s6('quantile_cont(diff, 0.975)')} AS q975
    FROM bd"""))
def q_bootstrap_diff(spark, sf_dir):
    return r6(resample.bootstrap_diff(_boot(spark, sf_dir), *AB))


# ------------------------------------------------------------ more distribution histograms
def _hist(src_sql: str, value: str, by: str | None = "exp_group") -> str:
    return _hist_sql(src_sql, value, P.hist_bins, by, f"min({value})", f"max({value})")


@register("smoothed_ctr_histogram", with_fixture(UC, SMOOTH, _hist("sm", "smoothed_ctr"), "SELECT * FROM hist"))
def q_smoothed_ctr_histogram(spark, sf_dir):
    sm = transforms.smoothed_ctr(_users(spark, sf_dir, AB, reuse=True), P.smooth_alpha)
    return r6(hist.histogram(sm, "smoothed_ctr", P.hist_bins, ("exp_group",)))


@register("lin_likes_histogram", with_fixture(UC, LIN, _hist("ll", "lin_likes"), "SELECT * FROM hist"))
def q_lin_likes_histogram(spark, sf_dir):
    ll = transforms.lin_likes(_users(spark, sf_dir, reuse=True), P.lin_control)
    return r6(hist.histogram(ll, "lin_likes", P.hist_bins, ("exp_group",)))


@register("bucket_ctr_histogram", with_fixture(UC, BUCKETS, _hist("bq", "bucket_ctr"), "SELECT * FROM hist"))
def q_bucket_ctr_histogram(spark, sf_dir):
    b = transforms.bucket_ctr(_users(spark, sf_dir, AB, reuse=True), P.n_buckets, None, "md5")
    return r6(hist.histogram(b, "bucket_ctr", P.hist_bins, ("exp_group",)))


@register("bootstrap_ctr_histogram", with_fixture(UC, BOOT_SQL, """
bctr AS (SELECT rep, exp_group, CAST(likes AS DOUBLE) / NULLIF(CAST(views AS DOUBLE), 0) AS global_ctr
         FROM boot)""", _hist("bctr", "global_ctr"), "SELECT * FROM hist"))
def q_bootstrap_ctr_histogram(spark, sf_dir):
    return r6(hist.histogram(_boot(spark, sf_dir, reuse=True), "global_ctr", P.hist_bins, ("exp_group",)))


@register("bootstrap_diff_histogram", with_fixture(UC, BOOT_SQL, BD_SQL, _hist("bd", "diff", None),
                                                   "SELECT * FROM hist"))
def q_bootstrap_diff_histogram(spark, sf_dir):
    d = resample.bootstrap_diffs(_boot(spark, sf_dir, reuse=True), *AB)
    return r6(hist.histogram(d, "diff", P.hist_bins))
