"""Ordered series: returns, rolling statistics, running products, lag alignment.

A series is (keys, order, value). One series may be most of the table, so nothing here puts a whole
series in one task: running operators use segments (see `order`), bounded frames use blocks of rows
with the neighbouring rows a frame needs copied in from the blocks beside it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemart.functions.numeric import number
from tidemart.operators.order import running, running_index
from tidemart.operators.stats import windowed_corr

BLOCK_ROWS = 1 << 16
INDEX = "__pos"


def in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most `before` rows back and `after` rows ahead.

    Rows are numbered per key and cut into blocks; the first and last rows of a block are copied to
    its neighbours, so every frame is whole inside a block. The copies are dropped afterwards.
    """
    size = max(block_rows, before + after + 1)
    placed = df if INDEX in df.columns else running_index(df, keys, order, INDEX)
    block = F.floor((F.col(INDEX) - 1) / size)
    offset = F.pmod(F.col(INDEX) - 1, F.lit(size))
    homes = F.array(
        block,
        F.when(offset >= size - before, block + 1) if before else F.lit(None).cast("bigint"),
        F.when((offset < after) & (block > 0), block - 1) if after else F.lit(None).cast("bigint"),
    )
    copies = placed.withColumn("__own", block).withColumn("__block", F.explode(F.filter(homes, lambda b: b.isNotNull())))
    window = W.partitionBy(*keys, "__block").orderBy(INDEX)
    return copies.withColumns(columns(window)).filter(F.col("__block") == F.col("__own")).drop(INDEX, "__own", "__block")


def daily_returns(df: DataFrame, keys: Sequence[str], order: Sequence[str], price: str = "Close", out: str = "daily_return", pad: bool = True) -> DataFrame:
    """Percent change of a coerced price; `pad` carries the last price over gaps first."""
    rows = df.withColumn("__price", number(F.col(price)))
    if pad:
        rows = running(rows, keys, order, {"__price": ("last", F.col("__price")), INDEX: ("sum", F.lit(1).cast("bigint"))})
    change = lambda w: {out: F.try_divide(F.col("__price"), F.lag("__price").over(w)) - 1}
    return in_blocks(rows, keys, order, 1, 0, change).drop("__price")


def volatility(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, window: int = 20, out: str = "volatility") -> DataFrame:
    """Rolling sample deviation; null until `window` values in a row are present."""

    def rolling(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(window - 1), 0)
        return {out: F.when(F.count(value).over(frame) == window, F.stddev_samp(value).over(frame))}

    return in_blocks(df, keys, order, window - 1, 0, rolling)


def cumulative_returns(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "cumulative_return") -> DataFrame:
    """Running product of 1 + return, minus 1; a null return stays null and the product goes on after it."""
    total = running(df, keys, order, {"__prod": ("product", 1 + F.col(value))})
    return total.withColumn(out, F.when(F.col(value).isNotNull(), F.col("__prod") - 1)).drop("__prod")


def up_down_target(value: Column, threshold: float = 0.0) -> Column:
    return F.coalesce(value > threshold, F.lit(False)).cast("int")


def significant_move(value: Column, threshold: float = 0.02) -> Column:
    return F.coalesce(F.abs(value) > threshold, F.lit(False))


def rolling_correlation(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, y: str, window: int = 30, out: str = "correlation") -> DataFrame:
    """Pearson over the last `window` rows; null unless all of them are complete pairs."""

    def rolling(w: WindowSpec) -> dict[str, Column]:
        r, n = windowed_corr(F.col(x), F.col(y), w.rowsBetween(-(window - 1), 0))
        return {out: F.when(n == window, r)}

    return in_blocks(df, keys, order, window - 1, 0, rolling)


def with_leads(df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, max_lag: int) -> DataFrame:
    """y and its next `max_lag` values beside every row, as y_0 ... y_max."""
    leads = lambda w: {f"y_{k}": F.lead(y, k).over(w) if k else F.col(y) for k in range(max_lag + 1)}
    return in_blocks(df, keys, order, 0, max_lag, leads)


def sharpe_ratio(df: DataFrame, keys: Sequence[str], value: str, risk_free_rate: float = 0.02, periods: int = 252) -> DataFrame:
    """Annualised Sharpe ratio per series, missing returns skipped; null when the returns do not vary."""
    excess = F.avg(F.col(value) - risk_free_rate / periods)
    ratio = F.try_divide(F.sqrt(F.lit(float(periods))) * excess, F.nullif(F.stddev_samp(value), F.lit(0.0)))
    return df.groupBy(*keys).agg(ratio.alias("sharpe_ratio"))


def daily_sentiment(df: DataFrame, date_col: str = "date", ticker_col: str = "stock") -> DataFrame:
    """Mean, deviation and count of the compound score, mean parts, per date and ticker."""
    keyed = df.filter(F.col(date_col).isNotNull() & F.col(ticker_col).isNotNull())
    return keyed.groupBy(date_col, ticker_col).agg(
        F.avg("compound").alias("avg_sentiment"), F.stddev_samp("compound").alias("sentiment_std"), F.count("compound").alias("news_count"),
        F.avg("pos").alias("pos_mean"), F.avg("neg").alias("neg_mean"), F.avg("neu").alias("neu_mean"),
    )


def align_news_with_prices(news: DataFrame, prices: DataFrame, date_col: str = "date", ticker_col: str = "stock") -> DataFrame:
    """Both sides to calendar days, inner joined on (day, ticker)."""
    return with_day(news, date_col).join(with_day(prices, date_col), [date_col, ticker_col])


def with_day(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(date_col, F.to_date(date_col))


def date_alignment(news: DataFrame, prices: DataFrame, date_col: str = "date", ticker_col: str = "stock") -> DataFrame:
    """How many (day, ticker) keys are on both sides, or on one only; keys are made distinct before the join."""
    sides = [
        with_day(d, date_col).select(date_col, ticker_col).distinct().withColumn(flag, F.lit(True)) for d, flag in ((news, "in_news"), (prices, "in_prices"))
    ]
    both = sides[0].join(sides[1], [date_col, ticker_col], "full")
    here, there = F.coalesce("in_news", F.lit(False)), F.coalesce("in_prices", F.lit(False))
    return both.agg(
        F.count_if(here & there).alias("matched"), F.count_if(here & ~there).alias("news_only"), F.count_if(~here & there).alias("prices_only")
    )


def market_features(news: DataFrame, prices: DataFrame, price: str = "Close", date_col: str = "date", ticker_col: str = "stock", window: int = 20) -> DataFrame:
    """Prices with returns, volatility, next move, and the day's sentiment."""
    keys, by = [ticker_col], [date_col]
    rows = daily_returns(with_day(prices, date_col), keys, by, price)
    rows = volatility(rows, keys, by, "daily_return", window)
    rows = rows.withColumns({"target": up_down_target(F.col("daily_return")), "significant_move": significant_move(F.col("daily_return"))})
    return align_news_with_prices(daily_sentiment(with_day(news, date_col), date_col, ticker_col), rows, date_col, ticker_col)
