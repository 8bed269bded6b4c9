"""Joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapstats.functions import columns as C

HOT_SHARE = 0.01      # keys above this share of the rows are joined apart; at most 2 / HOT_SHARE of them
TRACKED = 2000        # keys a sketch keeps; its error is about 3.5 / TRACKED of the rows
SKETCH_GROUPS = 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows; at most ``2 / share`` come back.

    One pass of frequent-item sketches per group of tasks, so that no single task receives
    a sketch from every other. A key with ``share`` of all rows is among the top of its
    groups with at least half of that. Only the balance of a join depends on the answer.
    """
    most = round(2 / share)
    tops = df.select(F.col(key).alias("k")).groupBy(C.task_group(SKETCH_GROUPS).alias("g")).agg(
        F.expr(f"approx_top_k(k, {most}, {TRACKED})").alias("items"), F.count(F.lit(1)).alias("n"))
    named = F.filter("items", lambda i: i["item"].isNotNull())
    total = F.struct(F.lit(None).alias("item"), F.col("n").alias("count"))      # the key None: all rows
    listed = tops.select(F.explode(F.concat(named, F.array(total))).alias("i")).groupBy("i.item").agg(
        F.sum("i.count").alias("rows"))
    rows = {r["item"]: r["rows"] for r in listed.orderBy(F.desc("rows")).limit(most + 1).collect()}
    return [k for k, n in rows.items() if k is not None and n > share / 2 * rows[None]]


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join to a side that has one row per key.

    The right side is an aggregate as a rule, so it needs no shuffle of its own and AQE
    would not split a skewed partition of the left. Instead rows of hot and null keys stay where
    they are, whatever their share: at most ``2 / HOT_SHARE`` rows of the right side match
    them, and these are sent to every task. All other keys are joined by shuffling.
    ``hot=[]`` says that no key of the left is frequent, and saves the pass that looks for them.
    """
    if hot is not None and not hot:
        return left.join(right, key, how)
    hot = hot_keys(left, key) if hot is None else hot
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    apart = left.filter(is_hot | F.col(key).isNull()).join(F.broadcast(right.filter(is_hot)), key, how)
    return left.filter(F.col(key).isNotNull() & ~is_hot).join(right, key, how).unionByName(apart)


def matched(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``left`` with what ``right`` has beside the keys and ``left`` has not; null keys match each other."""
    beside = [c for c in right.columns if c not in left.columns]
    named = right.select(*[F.col(k).alias(f"__right_{k}") for k in keys], *beside)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"__right_{k}" for k in keys])
