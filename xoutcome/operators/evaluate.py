"""Error measures of predictions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xoutcome import schema as S


def mae(y: Column, pred: Column) -> Column:
    return F.avg(F.abs(y - pred))


def mse(y: Column, pred: Column) -> Column:
    return F.avg((y - pred) * (y - pred))


def wmae(y: Column, pred: Column, weight: Column) -> Column:
    error = F.abs(y - pred)
    return F.try_divide(F.sum(weight * error), F.sum(F.when(error.isNotNull(), weight)))


def errors(df: DataFrame, by: list[str], y: str = "y", pred: str = "pred", weight: str = "w") -> DataFrame:
    """Plain and weighted errors per group."""
    yc, pc, wc = F.col(y), F.col(pred), F.col(weight)
    return df.groupBy(*by).agg(mae(yc, pc).alias("mae"), mse(yc, pc).alias("mse"), wmae(yc, pc, wc).alias("wmae"))


def wmae_next_weight(df: DataFrame, by: list[str], entity: list[str], day: str = "game_date", y: str = "y",
                     pred: str = "pred", weight: str = "w") -> DataFrame:
    """Weighted error where each row has the weight of the entity's next row.

    The target of a next-day model belongs to the next day, and so does its weight. An entity's last row has none.
    """
    following = F.lead(weight).over(Window.partitionBy(*by, *entity).orderBy(day))
    paired = df.withColumn("_w", following).filter(F.col("_w").isNotNull())
    return paired.groupBy(*by).agg(wmae(F.col(y), F.col(pred), F.col("_w")).alias("wmae"))


def eval_by_month(df: DataFrame, by: list[str], day: str = "game_date", y: str = "y", pred: str = "pred",
                  weight: str = "w", months: list[int] = S.SEASON_MONTHS) -> DataFrame:
    """Errors per month of the season."""
    dated = df.withColumn("month", F.month(day)).filter(F.col("month").isin(months))
    return errors(dated, [*by, "month"], y, pred, weight).drop("mse")


def month_table(by_month: DataFrame, by: list[str], measure: str, months: list[int] = S.SEASON_MONTHS) -> DataFrame:
    """One row per model, one column per month."""
    return by_month.groupBy(*by).pivot("month", months).agg(F.first(measure))


def tagged(predictions: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """One frame of all predictions, with their model and split."""
    frames = [
        df.select("game_date", "y", "pred", "w").withColumns({"model": F.lit(model), "split": F.lit(split)})
        for (model, split), df in predictions.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def eval_table(predictions: DataFrame) -> DataFrame:
    """Errors per model and split."""
    return errors(predictions, ["model", "split"])
