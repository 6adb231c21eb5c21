"""Questions over indicators and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def below_target(indicator: DataFrame, gap: str, by: str) -> DataFrame:
    """Territories below target and all territories, by network."""
    return indicator.groupBy(by).agg(F.count_if(F.col(gap) < 0).alias("below_target"), F.count(F.lit(1)).alias("territories"))


def trend(indicator: DataFrame, rate: str, keys: list[str], year: str) -> DataFrame:
    """Each year's rate and its change since the row's year before."""
    before = F.lag(rate).over(W.partitionBy(*keys).orderBy(year))
    return indicator.select(*keys, year, rate, (F.col(rate) - before).alias("change"))


def level_shares(df: DataFrame, keys: list[str], levels: list[str], weight: str) -> DataFrame:
    """Weighted mean share of each level, one row a key and level."""
    long = df.unpivot([*keys, weight], levels, "level", "share")
    mean = F.try_divide(F.sum(F.col("share") * F.col(weight)), F.sum(F.when(F.col("share").isNotNull(), F.col(weight))))
    return long.groupBy(*keys, "level").agg(mean.alias("share"))


def lowest_levels(df: DataFrame, keys: list[str], levels: list[str], weight: str) -> DataFrame:
    """Networks by their share in the given (lowest) levels, all levels summed."""
    return level_shares(df, keys, levels, weight).groupBy(*keys).agg(F.sum("share").alias("lowest_share"))


def score_against_target(indicator: DataFrame, keys: list[str], score: str, official: str) -> DataFrame:
    """Mean score beside the target; the scales differ, so no difference is taken."""
    return indicator.select(*keys, score, official)


def low_participation(targets: DataFrame, share: str, least: float) -> DataFrame:
    return targets.where(F.col(share) < least)


def worst_gaps(indicator: DataFrame, gap: str, by: str, ties: list[str], k: int) -> DataFrame:
    """The ``k`` rows of each network furthest below target, worst first."""
    place = F.row_number().over(W.partitionBy(by).orderBy(F.asc_nulls_last(gap), *ties))
    return indicator.withColumn("place", place).where((F.col("place") <= k) & F.col(gap).isNotNull())


def literate_by_score(df: DataFrame, score: str, cut: float = 743.0) -> DataFrame:
    """The literacy label that the score alone gives; null without a score."""
    return df.withColumn("literate_by_score", F.col(score) >= cut)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Keys whose totals differ between two tables, absent ones as zero."""
    l_, r_ = left.groupBy(*keys).agg(F.sum(a).alias("left_total")), right.groupBy(*keys).agg(F.sum(b).alias("right_total"))
    both = l_.join(r_, keys, "full_outer").na.fill(0, ["left_total", "right_total"])
    return both.withColumn("difference", F.col("left_total") - F.col("right_total")).where("difference <> 0")
