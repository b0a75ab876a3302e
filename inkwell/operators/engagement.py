"""Deliveries, opens and subscribers: roll-ups by post and month, running totals, year-over-year series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import round_half_up


def open_stats(opens: DataFrame, keys: list[str]) -> DataFrame:
    """Opens, distinct non-empty openers and the first open (as text) of each key."""
    return opens.groupBy(*keys).agg(F.count("*").alias("opens"), F.count_distinct(F.nullif("email", F.lit(""))).alias("unique_opens"), F.min(F.nullif("timestamp", F.lit(""))).alias("first_open"))


def post_engagement(posts: DataFrame, deliveries: DataFrame, opens: DataFrame) -> DataFrame:
    """Posts with delivered, active, opens, unique opens, open rate (3 places) and minutes to the first open (2 places).

    Sides are summed before they are joined; a post without rows has zeros, and rate and lag are null without a
    delivery or open.
    """
    sent = deliveries.groupBy("post_id").agg(F.count("*").alias("delivered"), F.count_if(F.col("active_subscription") == "true").alias("active"))
    out = posts.where((F.col("is_published") == "true") & (F.coalesce("post_id", F.lit("")) != "")).join(sent, "post_id", "left").join(open_stats(opens, ["post_id"]), "post_id", "left")
    for c in ("delivered", "active", "opens", "unique_opens"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    base = F.coalesce(F.nullif("email_sent_at", F.lit("")), F.nullif("post_date", F.lit(""))).try_cast("timestamp")
    lag = (F.unix_millis(F.col("first_open").try_cast("timestamp")) - F.unix_millis(base)) / 60000
    return out.withColumn("open_rate", F.when(F.col("delivered") > 0, round_half_up(F.col("unique_opens") / F.col("delivered"), 1000))).withColumn("open_lag_minutes", round_half_up(lag, 100))


def rate_percent(rate: Column) -> Column:
    """An open rate in per cent, to one place."""
    return F.floor(rate * 1000 + 0.5) / F.lit(10.0)


def histograms(opens: DataFrame, keys: list[str], kinds: dict[str, Column]) -> DataFrame:
    """(keys, kind, value, n) for several groupings in one pass; blanks count as Unknown."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unknown")).alias("value")) for k, c in kinds.items())))
    return opens.select(*keys, pairs.alias("x")).groupBy(*keys, "x.kind", "x.value").agg(F.count("*").alias("n"))


def monthly_engagement(posts: DataFrame, month: str = "month") -> DataFrame:
    """Sums by month, the ratio of sums as open rate, and the mean of lags that are known."""
    out = posts.groupBy(month).agg(F.sum("delivered").alias("delivered"), F.sum("opens").alias("opens"), F.sum("unique_opens").alias("unique_opens"), F.avg("open_lag_minutes").alias("lag"))
    rate = F.when(F.col("delivered") > 0, round_half_up(F.col("unique_opens") / F.col("delivered"), 1000))
    return out.select(month, "delivered", "opens", "unique_opens", rate.alias("open_rate"), round_half_up(F.col("lag"), 100).alias("avg_lag_minutes"))


def subscriber_growth(subscribers: DataFrame, created: str = "created_at", active: str = "active_subscription") -> DataFrame:
    """New and running subscribers by month of sign-up; months without any have no row. active is today's flag."""
    rows = subscribers.select(F.date_format(F.col(created).cast("string").try_cast("timestamp"), "yyyy-MM").alias("month"), (F.col(active).cast("string") == "true").alias("on"))
    months = rows.where("month is not null").groupBy("month").agg(F.count("*").alias("new"), F.count_if("on").alias("new_active"))
    run = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)  # a row a month
    return months.select("month", "new", "new_active", F.sum("new").over(run).alias("total"), F.sum("new_active").over(run).alias("total_active"))


def monthly_series(rows: DataFrame, date: Column, metrics: dict[str, Column]) -> DataFrame:
    """Twelve rows a year with the means of metrics (2 places, null for months without a value)."""
    named = rows.select(F.year(date).alias("year"), F.month(date).alias("month"), *(c.alias(k) for k, c in metrics.items())).where("year is not null")
    means = named.groupBy("year", "month").agg(*(round_half_up(F.avg(k), 100).alias(k) for k in metrics))
    grid = named.select("year").distinct().withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return grid.join(means, ["year", "month"], "left")


def yearly_series(rows: DataFrame, date: Column, metrics: dict[str, Column]) -> DataFrame:
    """Sum, count and mean (2 places) of each metric by year."""
    named = rows.select(F.year(date).alias("year"), *(c.alias(k) for k, c in metrics.items())).where("year is not null")
    out = [x for k in metrics for x in (round_half_up(F.sum(k), 100).alias(f"{k}_sum"), F.count(k).alias(f"{k}_count"), round_half_up(F.avg(k), 100).alias(f"{k}_avg"))]
    return named.groupBy("year").agg(*out).withColumn("latest", F.col("year") == F.max("year").over(Window.partitionBy()))  # a row a year
