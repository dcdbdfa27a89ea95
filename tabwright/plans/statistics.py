"""Queries: statistics and chart tables."""

from pyspark.sql import functions as F

from tabwright.functions import scalar as SC
from tabwright.operators import stats as ST
from tabwright.plans.registry import query, rnd, rounded, union_sql
from tabwright.sources.tables import ORDER_FRAME_SQL, order_frame, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"
COLS = ["acctbal", "n_lines", "sum_qty", "max_price", "target"]


@query("stat_skewness", f"{OF} " + union_sql(
    f"""select '{c}' as "column", count({c}) as n, {rnd(f'skewness({c})', 6)} as skew,
        {rnd(f'skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1))', 6)} as g1 from order_frame""" for c in COLS))
def stat_skewness(spark, sf):
    return rounded(ST.moments(order_frame(spark, sf), COLS).select("column", "n", "skew", "g1"), {"skew", "g1"}, 6)


@query("stat_kurtosis", f"{OF} " + union_sql(
    f"""select '{c}' as "column", {rnd(f'kurtosis({c})', 6)} as kurt, {rnd(f'kurtosis_pop({c})', 6)} as g2 from order_frame""" for c in COLS))
def stat_kurtosis(spark, sf):
    return rounded(ST.moments(order_frame(spark, sf), COLS).select("column", "kurt", "g2"), {"kurt", "g2"}, 6)


def _pairs_sql(src, cols, digits=6):
    return union_sql(
        f"""select cast({i} as integer) as i, cast({j} as integer) as j, '{cols[i]}' as "left", '{cols[j]}' as "right",
        cast(sum(case when {cols[i]} is not null and {cols[j]} is not null then 1 else 0 end) as bigint) as n,
        {rnd(f'corr({cols[i]}, {cols[j]})', digits)} as r from {src}""" for i in range(len(cols)) for j in range(i + 1, len(cols)))


@query("stat_corr_matrix", f"{OF} {_pairs_sql('order_frame', COLS)}")
def stat_corr_matrix(spark, sf):
    return rounded(ST.correlation_pairs(order_frame(spark, sf), COLS), {"r"}, 6)


@query("stat_corr_matrix_wide", f"{OF} {_pairs_sql('order_frame', COLS)}")
def stat_corr_matrix_wide(spark, sf):
    return rounded(ST.correlation_pairs(staged_order_frame(spark, sf), COLS), {"r"}, 6)


@query("stat_corr_mask", f"{OF} select * from ({_pairs_sql('order_frame', COLS)}) where abs(r) > 0.7")
def stat_corr_mask(spark, sf):
    return rounded(ST.correlation_pairs(order_frame(spark, sf), COLS).filter(F.abs("r") > 0.7), {"r"}, 6)


FEATURES = ["acctbal", "n_lines", "sum_qty", "max_price", "n_returned", "order_year"]


@query("stat_corr_target", f"{OF} select * from (" + union_sql(
    f"select '{c}' as \"column\", {rnd(f'corr({c}, target)', 6)} as r from order_frame" for c in FEATURES) + ") order by abs(r) desc limit 3")
def stat_corr_target(spark, sf):
    r = ST.correlation_with(order_frame(spark, sf), FEATURES, "target").orderBy(F.desc(F.abs("r")), "column").limit(3)
    return rounded(r.select("column", "r"), {"r"}, 6)


def _spearman_sql(c):
    return f"""select '{c}' as "column", count(*) as n, {rnd('corr(rx, ry)', 6)} as rho from (
      select rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as rx,
             rank() over (order by target) + (count(*) over (partition by target) - 1) / 2.0 as ry
      from order_frame where target is not null and {c} is not null)"""


@query("stat_spearman", f"{OF} " + union_sql(_spearman_sql(c) for c in FEATURES))
def stat_spearman(spark, sf):
    return rounded(ST.spearman(staged_order_frame(spark, sf), FEATURES, "target"), {"rho"}, 6)


@query("stat_ols_1d", f"""{OF} select {rnd('regr_slope(target, sum_qty)', 6)} as slope, {rnd('regr_intercept(target, sum_qty)')} as intercept,
    {rnd('regr_r2(target, sum_qty)', 6)} as r2, {rnd('regr_syy(target, sum_qty) / 1e6')} as sse_mean,
    {rnd('regr_syy(target, sum_qty) * (1 - regr_r2(target, sum_qty)) / 1e6')} as sse_line from order_frame""")
def stat_ols_1d(spark, sf):
    fit = ST.line_fit(order_frame(spark, sf), "sum_qty", "target")
    million = fit.withColumn("sse_mean", F.col("sse_mean") / 1e6).withColumn("sse_line", F.col("sse_line") / 1e6)
    return rounded(rounded(million, {"slope", "r2"}, 6), {"intercept", "sse_mean", "sse_line"})


@query("stat_residuals", f"""{OF}, fit as (select regr_slope(target, sum_qty) as b, regr_intercept(target, sum_qty) as a from order_frame)
    select row_id, {rnd('a + b * sum_qty')} as fitted, {rnd('target - (a + b * sum_qty)')} as residual
    from order_frame, fit where target is not null and sum_qty is not null""")
def stat_residuals(spark, sf):
    return rounded(ST.line_residuals(staged_order_frame(spark, sf), "row_id", "sum_qty", "target"), {"fitted", "residual"})


def _jb(c):
    n = f"count({c})"
    s = f"(skewness({c}) * ({n} - 2) / sqrt({n} * ({n} - 1)))"
    return f"({n} / 6.0 * ({s} * {s} + kurtosis_pop({c}) * kurtosis_pop({c}) / 4.0))"


@query("stat_normality", f"{OF} " + union_sql(
    f"""select '{c}' as "column", count({c}) as n, {rnd(_jb(c))} as jb, {rnd(f'exp(-{_jb(c)} / 2)', 6)} as p,
    exp(-{_jb(c)} / 2) >= 0.01 as normal from order_frame""" for c in COLS))
def stat_normality(spark, sf):
    return rounded(rounded(ST.jarque_bera(order_frame(spark, sf), COLS), {"jb"}), {"p"}, 6)


def _poly(powers, x):
    """A polynomial as SQL, highest power first."""
    out = repr(float(powers[0]))
    for p in powers[1:]:
        out = f"({out}) * {x} + {float(p)!r}"
    return f"({out})"


def _ks_sql():
    upper = f"case when x < 7.07106781186547 then exp(-x * x / 2) * {_poly(SC._HART, 'x')} / {_poly(SC._HART_BELOW, 'x')} else 0 end"
    terms = " + ".join(f"{2.0 * (-1) ** (i - 1)} * exp({-2.0 * i * i} * d * d * n)" for i in range(1, 31))
    return f"""with r as (select value, count(*)::double as cnt, sum(count(*)) over (order by value)::double as upto, sum(count(*)) over ()::double as n from events group by value),
      m as (select avg(value) as m, stddev_samp(value) as s from events),
      z as (select upto, cnt, n, (value - m) / s as z, abs((value - m) / s) as x from r, m),
      f as (select upto, cnt, n, case when z > 0 then 1 - ({upper}) else {upper} end as f from z),
      d as (select max(n) as n, max(greatest(f - (upto - cnt) / n, upto / n - f)) as d from f)
      select 'value' as "column", cast(n as bigint) as n, {rnd('d', 8)} as d, {rnd(f'case when d * sqrt(n) < 0.2 then 1 else greatest(0, least(1, {terms})) end', 6)} as p from d"""


@query("stat_normality_ks", _ks_sql())
def stat_normality_ks(spark, sf):
    return rounded(rounded(ST.kolmogorov_smirnov(table(spark, sf, "events"), ["value"]), {"d"}, 8), {"p"}, 6)


@query("stat_normality_w")
def stat_normality_w(spark, sf):
    """The W test of order columns: weights joined on exact ranks, the longest columns by their first 5,000 rows in hash order."""
    return ST.shapiro_wilk(order_frame(spark, sf), COLS, "row_id")


_R = "sqrt(-ln(least(position, 1 - position)))"
_THEORETICAL = f"""case when abs(position - 0.5) <= 0.425 then (position - 0.5) * {_poly(SC._CENTRE, 'c')} / {_poly(SC._CENTRE_BELOW, 'c')}
    else (case when position < 0.5 then -1 else 1 end) * (case when t <= 5 then {_poly(SC._MIDDLE, '(t - 1.6)')} / {_poly(SC._MIDDLE_BELOW, '(t - 1.6)')}
    else {_poly(SC._TAIL, '(t - 5)')} / {_poly(SC._TAIL_BELOW, '(t - 5)')} end) end"""


@query("stat_qq", f"""with r as (select value, count(*) as cnt, cast(sum(count(*)) over (order by value) as bigint) as rank,
      cast(sum(count(*)) over () as double) as n from events group by value),
    p as (select *, case when rank = n then power(0.5, 1 / n) when rank = 1 then 1 - power(0.5, 1 / n) else (rank - 0.3175) / (n + 0.365) end as position from r),
    t as (select *, 0.180625 - (position - 0.5) * (position - 0.5) as c, {_R} as t from p)
    select value, cnt, rank, {rnd('position', 8)} as position, {rnd(_THEORETICAL, 8)} as theoretical from t""")
def stat_qq(spark, sf):
    return rounded(ST.qq_points(table(spark, sf, "events"), ["value"]).drop("column"), {"position", "theoretical"}, 8)


@query("stat_qq_fit")
def stat_qq_fit(spark, sf):
    return ST.qq_fit(table(spark, sf, "events"), ["value"])


def _hist_sql(c):
    return f"""select '{c}' as "column", cast(case when hi > lo then least(floor(({c} - lo) / ((hi - lo) / 50)), 49) else 0 end as integer) as bin, count(*) as n
      from order_frame, (select cast(min({c}) as double) as lo, cast(max({c}) as double) as hi from order_frame) where {c} is not null group by 2"""


@query("stat_histogram", f"{OF} " + union_sql(_hist_sql(c) for c in ["acctbal", "max_price", "target"]))
def stat_histogram(spark, sf):
    return ST.histogram(staged_order_frame(spark, sf), ["acctbal", "max_price", "target"]).drop("left_edge")


@query("stat_histogram_width", "select floor(o_totalprice / 10000) * 10000 as left_edge, count(*) as n from orders group by 1")
def stat_histogram_width(spark, sf):
    return ST.histogram_width(table(spark, sf, "orders"), "o_totalprice", 10000.0).withColumn("left_edge", F.col("left_edge").cast("double"))


@query("stat_density_fit", f"""
    with m as (select count(value) as n, avg(value) as mu, stddev_pop(value) as s, avg(ln(value)) as lmu, stddev_pop(ln(value)) as ls from events)
    select 'normal' as family, {rnd('mu', 6)} as location, {rnd('s', 6)} as scale, {rnd('-n / 2.0 * (ln(2 * pi()) + 1 + 2 * ln(s))')} as log_likelihood from m
    union all select 'lognormal', {rnd('lmu', 6)}, {rnd('ls', 6)}, {rnd('-n / 2.0 * (ln(2 * pi()) + 1 + 2 * ln(ls)) - n * lmu')} from m""")
def stat_density_fit(spark, sf):
    out = ST.density_fit(table(spark, sf, "events"), "value")
    return rounded(rounded(out, {"location", "scale"}, 6), {"log_likelihood"})


@query("stat_density_curve", f"""with b as (select min(value) as lo, max(value) as hi, count(*) as n, stddev_samp(value) as s from events),
    c as (select least(floor((value - lo) / ((hi - lo) / 1000)), 999) as bin, count(*) as c from events, b group by 1),
    g as (select unnest(range(100)) as g)
    select cast(g as integer) as g, {rnd('lo + g * (hi - lo) / 99', 6)} as x,
      {rnd('''sum(c * exp(-power((lo + g * (hi - lo) / 99 - (lo + (bin + 0.5) * ((hi - lo) / 1000))) / (s * power(n, -0.2)), 2) / 2)
        / sqrt(2 * pi()) / (n * s * power(n, -0.2)))''', 8)} as density
    from c, g, b group by g, lo, hi""")
def stat_density_curve(spark, sf):
    out = ST.density_curve(table(spark, sf, "events"), "value")
    return rounded(rounded(out, {"x"}, 6), {"density"}, 8)


def _box_sql(src, value, group=None, label=None):
    by = f"partition by {group}" if group else ""
    key = f"{group}, " if group else ""
    return f"""select {key}{f"'{label}' as column_name, " if label else ''}{rnd('max(q1)')} as q1, {rnd('max(q2)')} as median, {rnd('max(q3)')} as q3,
      {rnd('min(case when inside then v end)')} as whisker_low, {rnd('max(case when inside then v end)')} as whisker_high,
      cast(sum(case when inside then 0 else 1 end) as bigint) as n_outliers from (
        select *, v >= q1 - 1.5 * (q3 - q1) and v <= q3 + 1.5 * (q3 - q1) as inside from (
          select {key}cast({value} as double) as v, quantile_cont(cast({value} as double), 0.25) over ({by}) as q1,
            quantile_cont(cast({value} as double), 0.5) over ({by}) as q2, quantile_cont(cast({value} as double), 0.75) over ({by}) as q3
          from {src} where {value} is not null)) {f'group by {group}' if group else ''}"""


BOX = {"q1", "median", "q3", "whisker_low", "whisker_high"}


@query("stat_box", f"{OF}, " + ", ".join(f"b{i} as ({_box_sql('order_frame', c)})" for i, c in enumerate(["qty_outlier", "max_price"]))
       + " select 'qty_outlier' as \"column\", * from b0 union all select 'max_price', * from b1")
def stat_box(spark, sf):
    return rounded(ST.box_stats(staged_order_frame(spark, sf), ["qty_outlier", "max_price"]), BOX)


@query("stat_box_by_level", _box_sql("events", "value", "event_type"))
def stat_box_by_level(spark, sf):
    return rounded(ST.box_stats(table(spark, sf, "events"), ["value"], by=["event_type"]), BOX).drop("column")


@query("stat_box_outliers", """with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
    select event_id, value from events, q where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)""")
def stat_box_outliers(spark, sf):
    return ST.box_outliers(table(spark, sf, "events"), "event_id", "value")


@query("stat_bar", union_sql(f"select '{c}' as \"column\", {c} as value, count(*) as cnt from lineitem group by {c}" for c in ("l_returnflag", "l_linestatus")))
def stat_bar(spark, sf):
    return ST.bar_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("stat_pair_sample", f"""{OF} select row_id, sum_qty, max_price from order_frame
    order by md5('42:' || row_id), row_id limit 300""")
def stat_pair_sample(spark, sf):
    return ST.pair_sample(order_frame(spark, sf), "row_id", ["sum_qty", "max_price"], 300)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("stat_pivot_mean", f"{OF} select nation, " + ", ".join(
    rnd(f"avg(case when segment = '{s}' then acctbal end)", 8) + f" as {s}" for s in SEGMENTS) + " from order_frame group by nation")
def stat_pivot_mean(spark, sf):
    return rounded(ST.pivot_mean(order_frame(spark, sf), "nation", "segment", "acctbal", SEGMENTS), set(SEGMENTS), 8)
