"""Queries: hold-out splits, folds, samples, and statistics fitted per fold."""

from pyspark.sql import functions as F

from tabwright.operators import learned as L
from tabwright.operators import split as S
from tabwright.plans.registry import query, rnd, rounded
from tabwright.session import materialize
from tabwright.sources.tables import FOLD_SQL, ORDER_FRAME_SQL, staged_order_frame, table

OF = f"with {ORDER_FRAME_SQL}"


def train(spark, sf):
    return staged_order_frame(spark, sf).filter(F.col("split") == "train")


@query("split_holdout", """select o_orderkey, case when row_number() over (order by md5('42:' || o_orderkey), o_orderkey)
    <= ceil(count(*) over () * 0.2) then 'val' else 'fit' end as part from orders""")
def split_holdout(spark, sf):
    return S.holdout(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("split_holdout_third", """select event_id, case when row_number() over (order by md5('7:' || event_id), event_id)
    <= ceil(count(*) over () * 0.33) then 'val' else 'fit' end as part from events""")
def split_holdout_third(spark, sf):
    return S.holdout(table(spark, sf, "events").select("event_id"), "event_id", 0.33, seed=7)


_NUMBER = "cast('0x' || substr(md5('{seed}:' || o_orderkey), 1, 8) as bigint)"


@query("fold_kfold_hash", f"select o_orderkey, cast({_NUMBER.format(seed=43)} % 5 as integer) as fold from orders")
def fold_kfold_hash(spark, sf):
    return S.kfold_hash(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


@query("split_holdout_hash", f"select o_orderkey, case when {_NUMBER.format(seed=42)} < {int(0.2 * 2**32)} then 'val' else 'fit' end as part from orders")
def split_holdout_hash(spark, sf):
    return S.holdout_hash(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("fold_kfold", f"{OF}, {FOLD_SQL} select row_id, fold from folds")
def fold_kfold(spark, sf):
    return S.kfold(train(spark, sf).select("row_id"), "row_id", 5)


@query("fold_contiguous", "select o_orderkey, cast(ntile(7) over (order by o_orderkey) - 1 as integer) as fold from orders")
def fold_contiguous(spark, sf):
    return S.contiguous(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 7)


@query("fold_stratified", """select o_orderkey, o_orderstatus,
    cast(ntile(5) over (partition by o_orderstatus order by md5('42:' || o_orderkey), o_orderkey) - 1 as integer) as fold from orders""")
def fold_stratified(spark, sf):
    return S.stratified(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 5)


@query("sample_rows", "select o_orderkey, o_totalprice from orders order by md5('42:' || o_orderkey), o_orderkey limit 300")
def sample_rows(spark, sf):
    return S.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 300)


EXPAND_SQL = f"""{OF}, {FOLD_SQL}, fits as (select cast(unnest(range(6)) as integer) as fit_fold),
    t as (select o.*, f.fold, fits.fit_fold from order_frame o join folds f using (row_id) join fits on fits.fit_fold <> f.fold)"""


def train_folds(spark, sf):
    """Training rows with their fold, written once: fit and apply both read them."""
    cols = ["row_id", "nation", "acctbal", "sum_qty", "max_price", "segment_gap"]
    return materialize(S.kfold(train(spark, sf).select(cols), "row_id", 5), "folds")


@query("fold_expand", f"""{EXPAND_SQL} select fit_fold, c as "column", n, {rnd('mean')} as mean, {rnd('lo')} as lo, {rnd('hi')} as hi, {rnd('m2 / n')} as var from (
    select fit_fold, 'acctbal' as c, count(acctbal)::double as n, avg(acctbal) as mean, min(acctbal) as lo, max(acctbal) as hi, var_pop(acctbal) * count(acctbal) as m2 from t group by 1
    union all select fit_fold, 'sum_qty', count(sum_qty)::double, avg(sum_qty), min(sum_qty), max(sum_qty), var_pop(sum_qty) * count(sum_qty) from t group by 1)""")
def fold_expand(spark, sf):
    m = L.fit_moments(train_folds(spark, sf), ["acctbal", "sum_qty"], "fold", 5)
    return rounded(m.withColumn("var", F.col("m2") / F.col("n")).drop("m2"), {"mean", "lo", "hi", "var"})


@query("fold_expand_median", f"""{EXPAND_SQL} select fit_fold, nation, {rnd('median(max_price)')} as value from t
    where max_price is not null group by 1, 2""")
def fold_expand_median(spark, sf):
    m = L.fit_median(train_folds(spark, sf), ["max_price"], "fold", 5, by=["nation"])
    return rounded(m.drop("column"), {"value"})


@query("fold_expand_mode", f"""{EXPAND_SQL}, c as (select fit_fold, segment_gap as value, count(*) as n from t where segment_gap is not null group by 1, 2)
    select fit_fold, value from (select *, row_number() over (partition by fit_fold order by n desc, value) as r from c) where r = 1""")
def fold_expand_mode(spark, sf):
    return L.fit_mode(train_folds(spark, sf), ["segment_gap"], "fold", 5).drop("column")
