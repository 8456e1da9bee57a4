"""Model transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators import transforms
from contractcheck.workload.base import query, table

RAW_SQL = """
raw AS (
  SELECT o_orderkey AS account_id, o_orderstatus AS status, CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS opened_date,
         CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 50 = 1 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS closed_date
  FROM orders)"""


def raw_accounts(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their dates as text, blank for some and malformed for a few."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select(
        k.alias("account_id"),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 4 == 0, "  ").otherwise(day).alias("opened_date"),
        F.when(k % 3 == 0, "").when(k % 50 == 1, "soon").otherwise(day).alias("closed_date"),
    )


@query(
    "staging_clean",
    f"""WITH {RAW_SQL} SELECT account_id, status, CASE WHEN trim(opened_date) = '' THEN NULL ELSE CAST(opened_date AS DATE) END AS opened_date
FROM raw""",
)
def staging_clean(spark, d):
    return transforms.staging(raw_accounts(spark, d).drop("closed_date"), ["opened_date"])


@query(
    "malformed_dates",
    f"""WITH {RAW_SQL}
SELECT 'opened_date' AS column_name, count(*) FILTER (trim(opened_date) <> '' AND TRY_CAST(opened_date AS DATE) IS NULL) AS rows_failed FROM raw
UNION ALL SELECT 'closed_date', count(*) FILTER (trim(closed_date) <> '' AND TRY_CAST(closed_date AS DATE) IS NULL) FROM raw""",
)
def malformed_dates(spark, d):
    return transforms.malformed_dates(raw_accounts(spark, d), ["opened_date", "closed_date"])


@query(
    "dim_model",
    f"""WITH {RAW_SQL} SELECT account_id, TRY_CAST(nullif(trim(opened_date), '') AS DATE) AS opened_date,
TRY_CAST(nullif(trim(closed_date), '') AS DATE) AS closed_date FROM raw""",
)
def dim_model(spark, d):
    staged = transforms.staging(raw_accounts(spark, d), ["opened_date", "closed_date"], strict=False)
    return transforms.dimension(staged, ["account_id", "opened_date", "closed_date"])


@query(
    "standardise",
    """
WITH m AS (SELECT upper(p_type) AS k, min('STD_' || p_type) AS standard FROM part WHERE p_type < 'M' GROUP BY 1)
SELECT p_partkey, coalesce(standard, upper(p_type)) AS p_type FROM part LEFT JOIN m ON k = upper(p_type)""",
)
def standardise(spark, d):
    part = table(spark, d, "part")
    mapping = part.filter("p_type < 'M'").select(
        F.lower("p_type").alias("raw"), F.concat(F.lit("STD_"), "p_type").alias("standard")
    )
    messy = part.select("p_partkey", F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")).alias("p_type"))
    return transforms.standardise(messy, "p_type", mapping)


RATES_SQL = """
rates AS (SELECT o_custkey % 25 AS currency, CAST(o_orderdate AS DATE) AS day,
                 CAST(0.5 AS DECIMAL(12,6)) + max(CAST(o_orderkey % 100 AS DECIMAL(12,6))) * CAST(0.01 AS DECIMAL(4,2)) AS rate
          FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2)"""


def rates(spark: SparkSession, d: str) -> DataFrame:
    """A daily rate per currency for most days, out of two thirds of the orders."""
    step = F.max((F.col("o_orderkey") % 100).cast("decimal(12,6)"))
    return (
        table(spark, d, "orders")
        .filter("o_orderkey % 3 <> 0")
        .groupBy((F.col("o_custkey") % 25).alias("currency"), F.to_date("o_orderdate").alias("day"))
        .agg((F.lit(0.5).cast("decimal(12,6)") + step * F.lit(0.01).cast("decimal(4,2)")).alias("rate"))
    )


FINE_SQL = f"""{RATES_SQL},
fine AS (SELECT currency, day, CAST(rate AS DECIMAL(18,8)) + CAST(0.00000037 AS DECIMAL(9,8)) AS rate FROM rates),
amounts AS (SELECT o_orderkey, o_custkey % 25 AS currency, CAST(o_orderdate AS DATE) AS day,
              CAST(o_totalprice AS DECIMAL(14,2)) + CAST(0.0049 AS DECIMAL(5,4)) AS amount FROM orders)"""


def fine_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates with eight places; currency 3 has two rates a day that differ."""
    some = rates(spark, d).withColumn("rate", F.col("rate").cast("decimal(18,8)") + F.lit("0.00000037").cast("decimal(9,8)"))
    return some.unionByName(some.filter("currency = 3").withColumn("rate", F.col("rate") + F.lit(1).cast("decimal(1,0)")))


def fine_amounts(spark: SparkSession, d: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(14,2)") + F.lit("0.0049").cast("decimal(5,4)")
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 25).alias("currency"), F.to_date("o_orderdate").alias("day"), amount.alias("amount"))


@query(
    "fx_convert",
    f"""WITH {FINE_SQL}
SELECT o_orderkey, amounts.currency, amounts.day, CASE WHEN amounts.currency <> 3 THEN CAST(CAST(amount * rate AS DECIMAL(38,2)) AS DOUBLE) END AS amount_usd,
       CASE WHEN rate IS NULL THEN 'no rate' WHEN amounts.currency = 3 THEN 'several rates' ELSE 'ok' END AS amount_usd_status
FROM amounts LEFT JOIN fine ON fine.currency = amounts.currency AND fine.day = amounts.day""",
)
def fx_convert(spark, d):
    """Amounts of four and rates of eight places, rounded once; a day with two rates is no amount but a finding."""
    done = transforms.convert_currency(fine_amounts(spark, d), "amount", "currency", "day", fine_rates(spark, d))
    return done.drop("amount").withColumn("amount_usd", F.col("amount_usd").cast("double"))


@query(
    "fx_asof",
    f"""WITH {FINE_SQL},
gaps AS (SELECT * FROM fine WHERE day(day) IN (1, 11) AND currency <> 7),
hot AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE currency END AS currency, day, amount FROM amounts)
SELECT o_orderkey, hot.currency, hot.day, gaps.day AS rate_day, CASE WHEN hot.currency <> 3 THEN CAST(CAST(amount * rate AS DECIMAL(38,2)) AS DOUBLE) END AS amount_usd,
       CASE WHEN rate IS NULL THEN 'no rate' WHEN hot.currency = 3 THEN 'several rates' ELSE 'ok' END AS amount_usd_status
FROM hot ASOF LEFT JOIN gaps ON gaps.currency = hot.currency AND hot.day >= gaps.day""",
)
def fx_asof(spark, d):
    """The newest rate up to the day. Rates come on few days, one currency owns half of the rows, one has no rate."""
    currency = F.when(F.col("o_orderkey") % 2 == 0, 5).otherwise(F.col("currency"))
    amounts = fine_amounts(spark, d).withColumn("currency", currency)
    known = fine_rates(spark, d).filter("day(day) IN (1, 11) AND currency <> 7")
    done = transforms.convert_as_of(amounts, "amount", "currency", "day", known, "o_orderkey", slices=8)
    return done.drop("amount").withColumn("amount_usd", F.col("amount_usd").cast("double"))


@query(
    "fx_last_known",
    f"""WITH {RATES_SQL} SELECT currency, CAST(arg_max(rate, day) AS DOUBLE) AS rate, max(day) AS day FROM rates
WHERE day <= DATE '1998-06-30' GROUP BY 1""",
)
def fx_last_known(spark, d):
    last = transforms.last_known_rates(rates(spark, d), "1998-06-30 00:00:00")
    return last.withColumn("rate", F.col("rate").cast("double"))


@query(
    "dormant_flag",
    f"""
WITH l AS (SELECT o_custkey, max(o_orderdate) AS last_activity FROM orders GROUP BY 1)
SELECT o_custkey, last_activity, CAST(date_diff('day', CAST(last_activity AS DATE), DATE '2001-10-01') AS INTEGER) AS idle_days,
       date_diff('day', CAST(last_activity AS DATE), DATE '2001-10-01') > 90 AS dormant FROM l""",
)
def dormant_flag(spark, d):
    return transforms.dormant(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "2001-10-01 00:00:00", 90)


