"""Feature joins: per-customer aggregates, transaction frequency, ranges of addresses, RFM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import parse_timestamp, purchase_parts, transaction_parts
from tidemart.operators.order import null_safe_join


def add_transaction_parts(df: DataFrame, time_col: str = "TransactionStartTime") -> DataFrame:
    """transaction_hour / day / month / year of a timestamp or of text in a known format."""
    return df.withColumns(transaction_parts(parse_timestamp(F.col(time_col))))


def add_purchase_parts(df: DataFrame, signup: str = "signup_time", purchase: str = "purchase_time") -> DataFrame:
    """Seconds from signup to purchase, hour and day of week (0 = Sunday) of the purchase."""
    return df.withColumns(purchase_parts(parse_timestamp(F.col(signup)), parse_timestamp(F.col(purchase))))


class CustomerAggregates:
    """Total, mean and number of a customer's amounts, learnt on one frame and joined to any other.

    A join on the aggregate, not a window: the counts combine map-side and a customer with very many
    rows is split by the adaptive skew join.
    """

    def __init__(self, customer: str = "CustomerId", amount: str = "Amount"):
        self.customer, self.amount, self.table = customer, amount, None

    def fit(self, df: DataFrame) -> CustomerAggregates:
        self.table = df.groupBy(self.customer).agg(
            F.sum(self.amount).alias("total_amount"), F.avg(self.amount).alias("avg_amount"), F.count(F.lit(1)).alias("txn_count")
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return null_safe_join(df, self.table, [self.customer])


def add_frequencies(df: DataFrame, columns: Sequence[str] = ("user_id", "device_id", "ip_address")) -> DataFrame:
    """Rows sharing the row's user, device and address; the counts are joined back, so hot keys stay split."""
    out = df
    for c in columns:
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_frequency"))
        out = null_safe_join(out, counts, [c])
    return out


def range_join(
    df: DataFrame, ranges: DataFrame, value: Column, lower: str, upper: str, columns: Sequence[str], bucket: float = 65536.0
) -> DataFrame:
    """Every row with the range that holds its value (inclusive); unmatched rows keep nulls.

    A range is repeated once per bucket it touches, so rows and ranges meet on an equi key and only
    a bucket's own ranges are compared.
    """
    low, high = F.floor(F.col(lower) / bucket), F.floor(F.col(upper) / bucket)
    spread = ranges.select(F.col(lower).alias("__low"), F.col(upper).alias("__high"), *columns, F.explode(F.sequence(low, high)).alias("__bucket"))
    left = df.withColumn("__value", value).withColumn("__slot", F.floor(F.col("__value") / bucket))
    match = (F.col("__slot") == F.col("__bucket")) & F.col("__value").between(F.col("__low"), F.col("__high"))
    return left.join(spread, match, "left").drop("__value", "__slot", "__bucket", "__low", "__high")


def add_country(df: DataFrame, ranges: DataFrame, ip: str = "ip_address") -> DataFrame:
    """Country of a numeric IPv4 address from (lower_bound_ip_address, upper_bound_ip_address, country)."""
    number = F.floor(F.col(ip).try_cast("double"))
    return range_join(df, ranges, number, "lower_bound_ip_address", "upper_bound_ip_address", ["country"])


def rfm(df: DataFrame, customer: str = "CustomerId", time: str = "TransactionStartTime", amount: str = "Amount") -> DataFrame:
    """Recency in days to the day after the last transaction of all, frequency, monetary sum, per customer."""
    t = parse_timestamp(F.col(time))
    per = df.groupBy(customer).agg(F.max(t).alias("__last"), F.count(F.lit(1)).alias("Frequency"), F.sum(amount).alias("Monetary"))
    snapshot = per.agg(F.date_add(F.to_date(F.max("__last")), 1)).scalar()
    return per.select(customer, F.datediff(snapshot, F.to_date("__last")).alias("Recency"), "Frequency", "Monetary")
