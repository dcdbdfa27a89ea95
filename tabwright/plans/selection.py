"""Queries: feature scores and filters."""

from pyspark.sql import functions as F

from tabwright.operators import select as S
from tabwright.plans.registry import query, rnd, rounded, union_sql
from tabwright.sources.tables import DOC_FRAME_SQL, ORDER_FRAME_SQL, doc_frame, order_frame, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"
FEATURES = ["acctbal", "n_lines", "sum_qty", "max_price", "n_returned", "order_year"]
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("fs_variance", "select * from (" + union_sql(
    f"select '{c}' as \"column\", {rnd(f'var_pop({c})', 8)} as variance from lineitem" for c in LINE) + ") where variance <= 0.01")
def fs_variance(spark, sf):
    return rounded(S.low_variance(table(spark, sf, "lineitem"), LINE, 0.01), {"variance"}, 8)


@query("fs_variance_vector", f"""select cast(i - 1 as integer) as position, {rnd('var_pop(v)', 8)} as variance from (
      select unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from embeddings) group by 1""")
def fs_variance_vector(spark, sf):
    return rounded(S.element_variances(table(spark, sf, "embeddings"), "embedding"), {"variance"}, 8)


@query("fs_f_regression", f"{OF} " + union_sql(
    f"""select '{c}' as "column", cast(sum(case when {c} is not null and target is not null then 1 else 0 end) as bigint) as n, {rnd(f'corr({c}, target)', 6)} as r,
    {rnd(f"power(corr({c}, target), 2) / (1 - power(corr({c}, target), 2)) * (sum(case when {c} is not null and target is not null then 1 else 0 end) - 2)")} as f
    from order_frame""" for c in FEATURES))
def fs_f_regression(spark, sf):
    return rounded(rounded(S.f_regression(order_frame(spark, sf), FEATURES, "target"), {"r"}, 6), {"f"})


def _mi_sql(src, cols, label):
    return union_sql(f"""select '{c}' as "column", {rnd('sum(c * 1.0 / n * ln(c * 1.0 * n / (nx * ny)))', 8)} as mi from (
      select c, sum(c) over (partition by x)::double as nx, sum(c) over (partition by y)::double as ny, sum(c) over ()::double as n
      from (select {c} as x, {label} as y, count(*)::double as c from {src} where {c} is not null group by 1, 2))""" for c in cols)


DISCRETE = ["status", "priority", "nation", "n_lines", "segment_gap"]


@query("fs_mutual_info", f"""{OF}, e as (select quantile_cont(target, [{', '.join(str(i / 10) for i in range(1, 10))}]) as e from order_frame),
    b as (select *, len(list_filter(e, lambda v: v < target)) as bin from order_frame, e where target is not null)
    {_mi_sql('b', DISCRETE, 'bin')}""")
def fs_mutual_info(spark, sf):
    return rounded(S.mutual_information(staged_order_frame(spark, sf), DISCRETE, "target"), {"mi"}, 8)


_GAPS = ", ".join(f"y - lag(y, {i}) over v, lead(y, {i}) over v - y" for i in (1, 2, 3))
_LEVELS = " union all ".join(
    f"""select '{c}' as col, cast({c} as varchar) as lvl, cast(target as double) as y from order_frame
    where {c} is not null and target is not null""" for c in DISCRETE)


@query("fs_mutual_info_neighbours", f"""{OF}, l as ({_LEVELS}),
    w as (select *, count(*) over (partition by col, lvl) as nx, [{_GAPS}] as g from l window v as (partition by col, lvl order by y)),
    r as materialized (select *, least(3, nx - 1) as k, list_sort(list_filter(g, lambda x: x is not null))[least(3, nx - 1)] as rad
      from w where nx > 1),
    c as materialized (select col, y, count(*) as own, sum(count(*)) over (partition by col order by y) as le from r group by 1, 2),
    m as (select r.*, case when rad > 0 then b.le - coalesce(a.le, 0) else o.own end as m
      from r join c o on r.col = o.col and r.y = o.y
      asof left join c a on r.col = a.col and r.y - r.rad >= a.y asof left join c b on r.col = b.col and r.y + r.rad > b.y),
    i as (select unnest(range(1, (select count(*) + 2 from order_frame))) as i),
    h as materialized (select i, coalesce(sum(1.0::double / i) over (order by i rows between unbounded preceding and 1 preceding), 0) - 0.5772156649015329 as p from i)
    select col as "column", {rnd('greatest(0.0, max(n.p) + avg(hk.p - hx.p - hm.p))', 8)} as mi
    from m join h hk on hk.i = k join h hx on hx.i = nx join h hm on hm.i = m.m
    join (select col, count(*) as n from r group by 1) s using (col) join h n on n.i = s.n group by col""")
def fs_mutual_info_neighbours(spark, sf):
    return rounded(S.mutual_information_neighbours(staged_order_frame(spark, sf), DISCRETE, "target"), {"mi"}, 8)


def _chi_sql(c):
    return f"""select '{c}' as "column", {rnd('sum(power(o - e, 2) / e)')} as chi2 from (
      select o, sum(o) over () * n / sum(n) over () as e from (select quality, sum({c})::double as o, count(*)::double as n
      from t where quality is not null group by quality))"""


_DOC = f"with {DOC_FRAME_SQL}, t as (select *, length(source) as source_len, length(lang) + doc_id % 7 as mixed from doc_frame)"


def _docs(spark, sf):
    return doc_frame(spark, sf).withColumn("source_len", F.length("source")).withColumn(
        "mixed", F.length("lang") + F.col("doc_id") % 7)


@query("fs_chi2", f"{_DOC} {union_sql(_chi_sql(c) for c in ('n_chars', 'source_len', 'mixed'))}")
def fs_chi2(spark, sf):
    return rounded(S.chi2(_docs(spark, sf), ["n_chars", "source_len", "mixed"], "quality"), {"chi2"})


@query("fs_chi2_top", f"{_DOC} select * from ({union_sql(_chi_sql(c) for c in ('n_chars', 'source_len', 'mixed'))}) order by chi2 desc limit 2")
def fs_chi2_top(spark, sf):
    return rounded(S.top_k(S.chi2(_docs(spark, sf), ["n_chars", "source_len", "mixed"], "quality"), "chi2", 2), {"chi2"})


@query("fs_percentile", f"{OF} select * from (" + union_sql(
    f"select '{c}' as \"column\", {rnd(f'power(corr({c}, target), 2)', 6)} as r2 from order_frame" for c in FEATURES) + ") order by r2 desc limit 2")
def fs_percentile(spark, sf):
    scores = S.f_regression(order_frame(spark, sf), FEATURES, "target").select("column", (F.col("r") * F.col("r")).alias("r2"))
    return rounded(S.top_percent(scores, "r2", 40), {"r2"}, 6)


def _anova_sql(src, c, label):
    return f"""select '{c}' as "column", {rnd('sum(n * power(m - gm, 2)) / (count(*) - 1) / (sum(n * v) / (sum(n) - count(*)))')} as f from (
      select n, m, v, sum(n * m) over () / sum(n) over () as gm from (
        select count({c})::double as n, avg({c}) as m, var_pop({c}) as v from {src} where {label} is not null group by {label}))"""


@query("fs_anova_f", f"with {ORDER_FRAME_SQL} {union_sql(_anova_sql('order_frame', c, 'segment') for c in ('acctbal', 'sum_qty', 'max_price', 'target'))}")
def fs_anova_f(spark, sf):
    return rounded(S.anova_f(order_frame(spark, sf), ["acctbal", "sum_qty", "max_price", "target"], "segment"), {"f"})


@query("fs_anova_docs", f"with {DOC_FRAME_SQL} {_anova_sql('doc_frame', 'n_chars', 'quality')}")
def fs_anova_docs(spark, sf):
    return rounded(S.anova_f(doc_frame(spark, sf), ["n_chars"], "quality"), {"f"})


@query("fs_info_gain", f"with {DOC_FRAME_SQL}, t as (select * from doc_frame where quality is not null) {_mi_sql('t', ['lang', 'source', 'toxic'], 'quality')}")
def fs_info_gain(spark, sf):
    return rounded(S.information_gain(doc_frame(spark, sf), ["lang", "source", "toxic"], "quality"), {"mi"}, 8)


_PRUNE = ["n_lines", "acctbal", "sum_qty", "n_returned", "target"]


@query("fs_corr_prune", f"{OF}, p as (" + union_sql(
    f"select cast({i} as integer) as i, '{_PRUNE[j]}' as \"column\", corr({_PRUNE[i]}, {_PRUNE[j]}) as r from order_frame"
    for i in range(5) for j in range(i + 1, 5)) + ") select \"column\", min(i) as first_match from p where abs(r) > 0.6 group by 1")
def fs_corr_prune(spark, sf):
    return S.correlated_columns(order_frame(spark, sf), _PRUNE, 0.6)


@query("fs_corr_prune_vector", """with v as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as pos from embeddings),
    r as (select a.pos as i, b.pos as j, corr(a.x, b.x) as r from v a join v b on a.vec_id = b.vec_id and a.pos < b.pos group by 1, 2)
    select 'e' || j as "column", cast(min(i) as integer) as first_match from r where r > 0.1 group by j""")
def fs_corr_prune_vector(spark, sf):
    emb = table(spark, sf, "embeddings")
    flat = S.array_columns(emb, "embedding")
    return S.correlated_columns(flat, flat.columns, 0.1, signed=True)
