"""Series, statistics and feature joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table
from catalog.profiling import quantities_with_nan
from tidemart.functions.tails import correlation_p_value
from tidemart.operators import features, series, stats

BY = ["ts", "event_id"]
RETURNS_SQL = """
ret AS (SELECT event_type, ts, event_id, value, value / nullif(lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 0) - 1 AS r FROM events)"""


def p_sql(r: str, n: str) -> str:
    """Two-sided t tail of a correlation by its finite trigonometric series (n - 2 degrees of freedom)."""
    even = f"abs({r}) * list_sum(list_transform(range(0, CAST(({n} - 2) // 2 AS BIGINT)), lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1) - 0.5 * ln(pi())) * pow(1 - {r} * {r}, j)))"
    odd = (
        f"2 / pi() * (asin(abs({r})) + abs({r}) * sqrt(1 - {r} * {r}) * coalesce(list_sum(list_transform(range(0, CAST(({n} - 3) // 2 AS BIGINT)), "
        f"lambda j: exp(lgamma(j + 1) - lgamma(j + 1.5)) * sqrt(pi()) / 2 * pow(1 - {r} * {r}, j))), 0))"
    )
    return f"(1 - CASE WHEN ({n} - 2) % 2 = 0 THEN {even} ELSE {odd} END)"


def returns(spark, sf):
    e = table(spark, sf, "events").select("event_type", "ts", "event_id", "value")
    return series.daily_returns(e, ["event_type"], BY, "value", "r")


@query("WIN2", f"WITH {RETURNS_SQL} SELECT event_id, round(r, 6) AS r FROM ret")
def percent_changes(spark, sf):
    return returns(spark, sf).select("event_id", F.round("r", 6).alias("r"))


@query("WIN2", """WITH g AS (SELECT event_type, ts, event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM events),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM g)
SELECT event_id, round(p / lag(p) OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1, 6) AS r FROM f""")
def percent_changes_with_gaps(spark, sf):
    text = F.when(F.col("event_id") % 4 != 0, F.col("value").cast("string")).otherwise("n/a")
    e = table(spark, sf, "events").select("event_type", "ts", "event_id", text.alias("v"))
    return series.daily_returns(e, ["event_type"], BY, "v", "r").select("event_id", F.round("r", 6).alias("r"))


@query("WIN3", f"""WITH {RETURNS_SQL} SELECT event_id, round(CASE WHEN count(r) OVER w = 20 THEN stddev_samp(r) OVER w END, 6) AS volatility FROM ret
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def rolling_volatility(spark, sf):
    v = series.volatility(returns(spark, sf), ["event_type"], BY, "r", 20)
    return v.select("event_id", F.round("volatility", 6).alias("volatility"))


@query("WIN4", """WITH q AS (SELECT *, CASE WHEN event_id % 6 <> 0 THEN (value - 100) / 100000 END AS r FROM events)
SELECT event_id, round(CASE WHEN r IS NOT NULL THEN product(1 + coalesce(r, 0)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END, 6) + 0.0 AS cumulative_return FROM q""")
def cumulative_returns(spark, sf):
    e = table(spark, sf, "events").select("event_type", "ts", "event_id", F.when(F.col("event_id") % 6 != 0, (F.col("value") - 100) / 100000).alias("r"))
    c = series.cumulative_returns(e, ["event_type"], BY, "r")
    return c.select("event_id", (F.round("cumulative_return", 6) + 0.0).alias("cumulative_return"))


@query("WIN5 WIN6", f"""WITH {RETURNS_SQL} SELECT event_id, CAST(coalesce(r > 0.1, FALSE) AS BIGINT) AS target, coalesce(abs(r) > 0.02, FALSE) AS significant FROM ret""")
def move_flags(spark, sf):
    r = F.col("r")
    return returns(spark, sf).select("event_id", series.up_down_target(r, 0.1).cast("bigint").alias("target"), series.significant_move(r).alias("significant"))


@query("WIN7", """WITH m AS (SELECT event_type, ts, event_id, value AS x, user_id::DOUBLE AS y FROM events)
SELECT event_id, round(CASE WHEN count(*) OVER w = 30 AND var_pop(x) OVER w > 0 AND var_pop(y) OVER w > 0 THEN corr(x, y) OVER w END, 6) AS correlation FROM m
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_correlation(spark, sf):
    e = table(spark, sf, "events").select("event_type", "ts", "event_id", F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"))
    c = series.rolling_correlation(e, ["event_type"], BY, "x", "y", 30)
    return c.select("event_id", F.round("correlation", 6).alias("correlation"))


LAGS_SQL = "m AS (SELECT event_type, value AS x, user_id::DOUBLE AS y, " + ", ".join(
    f"lead(user_id::DOUBLE, {k}) OVER w AS y_{k}" for k in range(6)
) + " FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),\nc AS (" + " UNION ALL ".join(
    f"SELECT {k} AS lag, corr(x, y_{k}) AS r, count(CASE WHEN x IS NOT NULL AND y_{k} IS NOT NULL THEN 1 END) AS n FROM m" for k in range(6)
) + ")"


@query("WIN8 STAT3", f"""WITH {LAGS_SQL} SELECT CAST(lag AS BIGINT) AS lag, round(r, 6) AS correlation, round({p_sql('r', 'n')}, 6) AS p_value,
{p_sql('r', 'n')} < 0.05 AS significant, n AS n_samples FROM c""")
def lagged_correlation(spark, sf):
    e = table(spark, sf, "events").select("event_type", "ts", "event_id", F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"))
    out = stats.lagged(series.with_leads(e, ["event_type"], BY, "y", 5), "x", 5)
    return out.withColumns({"lag": F.col("lag").cast("bigint"), "correlation": F.round("correlation", 6), "p_value": F.round("p_value", 6)})


@query("AGG26", f"""WITH {RETURNS_SQL} SELECT event_type, round(sqrt(252) * avg(r - 0.02 / 252) / stddev_samp(r), 6) AS sharpe_ratio FROM ret GROUP BY 1""")
def sharpe_ratios(spark, sf):
    return series.sharpe_ratio(returns(spark, sf), ["event_type"], "r").withColumn("sharpe_ratio", F.round("sharpe_ratio", 6))


SCORES_SQL = """
sc AS (SELECT CAST(ts AS DATE) AS "date", event_type AS stock, CASE WHEN event_id % 9 <> 0 THEN (value - 50) / 100 END AS compound,
  (user_id % 10) / 10.0 AS pos, (user_id % 7) / 10.0 AS neg, (user_id % 5) / 10.0 AS neu FROM events)"""


def scored_headlines(spark, sf):
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        F.to_date("ts").alias("date"), F.col("event_type").alias("stock"),
        F.when(F.col("event_id") % 9 != 0, (F.col("value") - 50) / 100).alias("compound"),
        (u % 10 / 10.0).alias("pos"), (u % 7 / 10.0).alias("neg"), (u % 5 / 10.0).alias("neu"),
    )


DAILY = ("avg_sentiment", "sentiment_std", "pos_mean", "neg_mean", "neu_mean")
DAILY_SQL = """daily AS (SELECT "date", stock, avg(compound) AS avg_sentiment, stddev_samp(compound) AS sentiment_std, count(compound) AS news_count,
  avg(pos) AS pos_mean, avg(neg) AS neg_mean, avg(neu) AS neu_mean FROM sc GROUP BY 1, 2)"""


@query("AGG10", f"""WITH {SCORES_SQL}, {DAILY_SQL} SELECT "date", stock, news_count, """ + ", ".join(f"round({c}, 6) AS {c}" for c in DAILY) + " FROM daily")
def daily_sentiment(spark, sf):
    return series.daily_sentiment(scored_headlines(spark, sf)).withColumns({c: F.round(c, 6) for c in DAILY})


PRICES_SQL = """pr AS (SELECT CAST(ts AS DATE) AS "date", event_type AS stock, avg(value) AS "Close" FROM events WHERE event_type <> 'view' GROUP BY 1, 2)"""


def prices(spark, sf):
    e = table(spark, sf, "events").filter("event_type <> 'view'")
    return e.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("stock")).agg(F.avg("value").alias("Close"))


@query("JOIN10", f"""WITH {SCORES_SQL}, {DAILY_SQL}, {PRICES_SQL}, r AS (SELECT *, "Close" / lag("Close") OVER (PARTITION BY stock ORDER BY "date") - 1 AS daily_return FROM pr),
v AS (SELECT *, CASE WHEN count(daily_return) OVER w = 5 THEN stddev_samp(daily_return) OVER w END AS volatility FROM r WINDOW w AS (PARTITION BY stock ORDER BY "date" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT "date", stock, news_count, round("Close", 6) AS "Close", round(daily_return, 6) AS daily_return, round(volatility, 6) AS volatility,
  CAST(coalesce(daily_return > 0, FALSE) AS BIGINT) AS target, coalesce(abs(daily_return) > 0.02, FALSE) AS significant_move, """
       + ", ".join(f"round({c}, 6) AS {c}" for c in DAILY) + """ FROM daily JOIN v USING ("date", stock)""")
def market_features(spark, sf):
    out = series.market_features(scored_headlines(spark, sf), prices(spark, sf), window=5)
    return out.withColumns({**{c: F.round(c, 6) for c in (*DAILY, "Close", "daily_return", "volatility")}, "target": F.col("target").cast("bigint")})


@query("JOIN10", f"""WITH {SCORES_SQL}, {PRICES_SQL}, k AS (SELECT DISTINCT "date", stock, TRUE AS a FROM sc) SELECT count(CASE WHEN a AND "Close" IS NOT NULL THEN 1 END) AS matched,
  count(CASE WHEN a AND "Close" IS NULL THEN 1 END) AS news_only, count(CASE WHEN a IS NULL THEN 1 END) AS prices_only FROM k FULL JOIN pr USING ("date", stock)""")
def date_alignment(spark, sf):
    return series.date_alignment(scored_headlines(spark, sf), prices(spark, sf))


# Statistics.

@query("JOIN8", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 600)")
def frequent_supplier_lines(spark, sf):
    return stats.frequent_groups(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", 600)


@query("STAT1", f"""WITH c AS (SELECT l_returnflag, corr(l_quantity, l_tax) AS r, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(r, 6) AS correlation, round({p_sql('r', 'n')}, 6) AS p_value, {p_sql('r', 'n')} < 0.05 AS significant, n AS n_samples FROM c""")
def pearson_by_flag(spark, sf):
    out = stats.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_tax", keys=["l_returnflag"])
    return out.withColumns({"correlation": F.round("correlation", 6), "p_value": F.round("p_value", 6)})


@query("STAT1", f"""WITH c AS (SELECT corr(CASE WHEN l_linenumber <> 3 THEN l_quantity END, l_tax) AS r, count(CASE WHEN l_linenumber <> 3 THEN 1 END) AS n FROM lineitem)
SELECT round(r, 6) AS correlation, round({p_sql('r', 'n')}, 6) AS p_value, {p_sql('r', 'n')} < 0.05 AS significant, n AS n_samples FROM c""")
def pearson_with_nan(spark, sf):
    out = stats.pearson(quantities_with_nan(spark, sf), "x", "l_tax")
    return out.withColumns({"correlation": F.round("correlation", 6), "p_value": F.round("p_value", 6)})


@query("STAT2", f"""WITH l AS (SELECT * FROM lineitem WHERE l_linenumber <> 3), r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_tax) - 1) / 2.0 AS b FROM l), c AS (SELECT corr(a, b) AS r, count(*) AS n FROM r)
SELECT round(r, 6) AS correlation, round({p_sql('r', 'n')}, 6) AS p_value, {p_sql('r', 'n')} < 0.05 AS significant FROM c""")
def spearman_with_nan(spark, sf):
    out = stats.spearman(quantities_with_nan(spark, sf), "x", "l_tax")
    return out.withColumns({"correlation": F.round("correlation", 6), "p_value": F.round("p_value", 6)})


@query("STAT2", f"""WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem),
c AS (SELECT corr(a, b) AS r, count(*) AS n FROM r)
SELECT round(r, 6) AS correlation, round({p_sql('r', 'n')}, 6) AS p_value, {p_sql('r', 'n')} < 0.05 AS significant FROM c""")
def spearman_price_quantity(spark, sf):
    out = stats.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return out.withColumns({"correlation": F.round("correlation", 6), "p_value": F.round("p_value", 6)})


@query("STAT4", f"""WITH c AS (SELECT l_suppkey, corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_suppkey, n >= 3 AND {p_sql('r', 'n')} < 0.05 AS significant, round({p_sql('r', 'n')}, 6) AS p_value FROM c""")
def correlation_significance(spark, sf):
    r, n = stats.guarded_corr(F.col("l_quantity"), F.col("l_extendedprice"))
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(r.alias("r"), n.alias("n"))
    return per.select("l_suppkey", stats.is_significant(F.col("r"), F.col("n")).alias("significant"), F.round(correlation_p_value("r", "n"), 6).alias("p_value"))


POLICIES_SQL = """
pol AS (SELECT l_suppkey AS "PolicyID", l_shipdate AS "TransactionMonth", l_extendedprice AS "TotalPremium", l_extendedprice * l_discount AS "TotalClaims",
  CAST(l_discount > 0.05 AS INTEGER) AS claim_flag, l_extendedprice * (1 - l_discount) AS margin, nullif(l_returnflag, 'N') AS flag, l_linestatus AS status, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem)"""


def policies(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("PolicyID"), F.col("l_shipdate").alias("TransactionMonth"), price.alias("TotalPremium"), (price * discount).alias("TotalClaims"),
        (discount > 0.05).cast("int").alias("claim_flag"), (price * (1 - discount)).alias("margin"), F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.col("l_linestatus").alias("status"), F.col("l_linenumber").cast("string").alias("line"),
    )


@query("AGG11 JOIN8 SCL18", f"""WITH {POLICIES_SQL} SELECT flag, count(DISTINCT "PolicyID") AS policies, count("TransactionMonth") AS exposure_months,
  round(sum("TotalPremium"), 0) AS premium_sum, round(sum("TotalClaims"), 0) AS claims_sum, sum(claim_flag)::DOUBLE AS claimants, round(avg(claim_flag), 6) AS claim_rate,
  round(avg(margin), 3) AS margin_mean, round(sum("TotalClaims") / sum(claim_flag), 3) AS severity, round(sum("TotalClaims") / sum("TotalPremium"), 6) AS loss_ratio
FROM pol WHERE flag IS NOT NULL GROUP BY flag HAVING count(*) >= 500""")
def segment_kpis(spark, sf):
    digits = {"premium_sum": 0, "claims_sum": 0, "claim_rate": 6, "margin_mean": 3, "severity": 3, "loss_ratio": 6}
    return stats.segment_kpis(policies(spark, sf), "flag").withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("STAT5 STAT7", f"""WITH {POLICIES_SQL}, g AS (SELECT line, count(*) AS gn, sum(claim_flag) AS g1 FROM pol GROUP BY 1 HAVING count(*) >= 500),
t AS (SELECT sum(gn) AS n, sum(g1) AS m1, count(*) AS k FROM g),
s AS (SELECT sum(pow(g1 - gn * m1 / n, 2) / (gn * m1 / n) + pow((gn - g1) - gn * (n - m1) / n, 2) / (gn * (n - m1) / n)) AS x, any_value(k) AS k FROM g, t)
SELECT 'claims by line' AS test, round(x, 6) AS statistic, round(exp(-x / 2) * (1 + x / 2 + x * x / 8), 6) AS p_value, k AS groups_tested, 0.05::DOUBLE AS alpha,
  CASE WHEN exp(-x / 2) * (1 + x / 2 + x * x / 8) < 0.05 THEN 'Reject H0' ELSE 'Fail to reject H0' END AS decision FROM s""")
def claims_chi_square(spark, sf):
    out = stats.test_row(stats.chi_square(policies(spark, sf), "line"), "claims by line")
    return out.withColumns({"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)})


@query("STAT5", f"""WITH {POLICIES_SQL}, c AS (SELECT status, claim_flag, count(*) AS o FROM pol GROUP BY 1, 2),
m AS (SELECT *, sum(o) OVER (PARTITION BY status) * sum(o) OVER (PARTITION BY claim_flag) / (sum(o) OVER ())::DOUBLE AS e FROM c)
SELECT round(sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e), 6) AS stat, CAST(1 AS BIGINT) AS dof, count(DISTINCT status) AS groups FROM m""")
def claims_chi_square_two_by_two(spark, sf):
    return stats.chi_square(policies(spark, sf), "status").select(F.round("stat", 6).alias("stat"), "dof", "groups")


@query("STAT6 STAT7", f"""WITH {POLICIES_SQL}, keep AS (SELECT line FROM pol GROUP BY 1 HAVING count(*) >= 500), k AS (SELECT line, margin FROM pol WHERE line IN (SELECT line FROM keep)),
r AS (SELECT line, margin, rank() OVER (ORDER BY margin) + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS rk, count(*) OVER () AS n FROM k),
ties AS (SELECT sum(pow(t, 3) - t) AS tt FROM (SELECT count(*) AS t FROM k GROUP BY margin)),
g AS (SELECT line, count(*) AS gn, avg(rk) AS mr, any_value(n)::DOUBLE AS n FROM r GROUP BY 1),
h AS (SELECT 12 / (any_value(n) * (any_value(n) + 1)) * sum(gn * pow(mr - (n + 1) / 2, 2)) / (1 - any_value(tt) / (pow(any_value(n), 3) - any_value(n))) AS x, count(*) AS k FROM g, ties)
SELECT 'margin by line' AS test, round(x, 6) AS statistic, round(exp(-x / 2) * (1 + x / 2 + x * x / 8), 6) AS p_value, k AS groups_tested, 0.05::DOUBLE AS alpha,
  CASE WHEN exp(-x / 2) * (1 + x / 2 + x * x / 8) < 0.05 THEN 'Reject H0' ELSE 'Fail to reject H0' END AS decision FROM h""")
def margin_kruskal(spark, sf):
    out = stats.test_row(stats.kruskal(policies(spark, sf), "line", "margin"), "margin by line")
    return out.withColumns({"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)})


FEATURES = ("l_linenumber", "l_quantity", "l_extendedprice", "l_tax")


@query("STAT8", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, l_discount), 6) + 0.0 AS corr, round(abs(corr({c}, l_discount)), 6) AS abs_corr FROM lineitem" for c in FEATURES))
def target_correlations(spark, sf):
    out = stats.target_correlations(table(spark, sf, "lineitem"), "l_discount", ["l_orderkey", "l_partkey", "l_suppkey"])
    return out.withColumns({"corr": F.round("corr", 6) + 0.0, "abs_corr": F.round("abs_corr", 6)})


@query("STAT9 VIZ8", " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", " + ", ".join(f"round(corr({a}, {b}), 6) + 0.0 AS {b}" for b in FEATURES) + " FROM lineitem" for a in FEATURES))
def correlation_matrix(spark, sf):
    return stats.correlation_matrix(table(spark, sf, "lineitem"), FEATURES).withColumns({c: F.round(c, 6) + 0.0 for c in FEATURES})


# Feature joins.

@query("JOIN11", """SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS total_amount, round(avg(o_totalprice) OVER w, 6) AS avg_amount, count(*) OVER w AS txn_count
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def customer_aggregates(spark, sf):
    o = table(spark, sf, "orders")
    out = features.CustomerAggregates("o_custkey", "o_totalprice").fit(o).transform(o)
    return out.select("o_orderkey", F.round("total_amount", 2).alias("total_amount"), F.round("avg_amount", 6).alias("avg_amount"), "txn_count")


@query("AGG29", """SELECT event_id, count(*) OVER (PARTITION BY user_id) AS user_id_frequency, count(*) OVER (PARTITION BY event_type) AS event_type_frequency, count(*) OVER (PARTITION BY props) AS props_frequency FROM events""")
def transaction_frequencies(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return features.add_frequencies(e, ["user_id", "event_type", "props"]).drop("user_id", "event_type", "props")


@query("JOIN9", """WITH rg AS (SELECT p_partkey * 70001 AS lo, p_partkey * 70001 + 30000 + p_size * 1000 AS hi, p_brand AS country FROM part)
SELECT event_id, country FROM (SELECT event_id, (event_id * 7919 + user_id * 104729) % (70001 * 2000) AS ip FROM events) LEFT JOIN rg ON ip BETWEEN lo AND hi""")
def country_ranges(spark, sf):
    low = F.col("p_partkey") * 70001
    ranges = table(spark, sf, "part").select(
        low.alias("lower_bound_ip_address"), (low + 30000 + F.col("p_size") * 1000).alias("upper_bound_ip_address"), F.col("p_brand").alias("country")
    )
    ip = (F.col("event_id") * 7919 + F.col("user_id") * 104729) % (70001 * 2000)
    e = table(spark, sf, "events").select("event_id", ip.cast("double").alias("ip_address"))
    return features.add_country(e, ranges).select("event_id", "country")


@query("AGG24", """SELECT o_custkey, date_diff('day', max(o_orderdate)::DATE, (SELECT max(o_orderdate)::DATE + 1 FROM orders)) AS "Recency", count(*) AS "Frequency",
round(sum(o_totalprice), 2) AS "Monetary" FROM orders GROUP BY 1""")
def customer_rfm(spark, sf):
    out = features.rfm(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice")
    return out.withColumns({"Recency": F.col("Recency").cast("bigint"), "Monetary": F.round("Monetary", 2)})
