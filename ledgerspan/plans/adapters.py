"""Transactions, accounting close and contracts derived from the star-schema test tables.

The rules are written down in ``FIXTURES.md`` (section 3); the oracle states the same ones in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import apply_contract_changes
from ..operators.premiums import monthly_premiums
from ..operators.silver import to_silver
from ..schemas import PARTIES
from ..sources.landing import with_provenance

AS_OF = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows from ``orders``, with a share of bad timestamps and amounts, and of unknown or missing parties and statuses."""
    key, at = F.col("o_orderkey"), F.col("at")
    text = F.concat(
        F.month(at), F.lit("/"), F.dayofmonth(at), F.lit("/"), F.year(at), F.lit(" "),
        F.hour(at), F.lit(":"), F.lpad(F.minute(at), 2, "0"), F.lit(":"), F.lpad(F.second(at), 2, "0"),
    )
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    party = F.element_at(F.array(*[F.lit(p) for p in PARTIES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    orders = table(spark, sf_dir, "orders").withColumn(
        "at", F.col("o_orderdate") + F.make_dt_interval(secs=(key * 7919 % 86400).cast("decimal(18,6)"))
    )
    return orders.select(
        key.cast("string").alias("transaction_id"),
        F.when(key % 97 == 0, "not a date").otherwise(text).alias("created_at"),
        F.when(key % 101 == 0, "n/a")
        .when(key % 103 == 0, F.concat(F.lit("-"), amount))
        .when(key % 107 == 0, "0.00")
        .otherwise(amount)
        .alias("premium_amount"),
        F.lit("EUR").alias("premium_currency"),
        F.when(key % 113 == 0, "newpartner").when(key % 109 != 0, party).alias("charged_party"),
        F.when(key % 127 == 0, "chargeback")
        .when(key % 131 == 0, F.lit(None))
        .when(key % 11 == 0, "failed")
        .when(F.col("o_orderstatus") == "F", "processed")
        .when(F.col("o_orderstatus") == "O", "process")
        .when(F.col("o_orderstatus") == "P", "refunded")
        .alias("status"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_provenance(raw_transactions(spark, sf_dir), "orders.parquet")


def silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return to_silver(bronze(spark, sf_dir), **options).drop("_bronze_ingested_at")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_premiums(silver(spark, sf_dir))


def accounting_from(monthly: DataFrame) -> DataFrame:
    """An accounting close that agrees, nearly agrees, differs or is silent, by month."""
    turn = (F.substring("month", 1, 4).cast("int") * 12 + F.substring("month", 6, 2).cast("int")) % 5
    figures = monthly.where(turn != 3).select(
        "party", "month", F.rint(F.col("written_premium") * 100).cast("bigint").alias("cents"), turn.alias("turn")
    )
    stated = (
        F.when(F.col("turn") == 1, F.expr("cents * 1004 div 1000"))
        .when(F.col("turn") == 2, F.expr("cents * 103 div 100"))
        .otherwise(F.col("cents"))
    ) / F.lit(100.0)
    silent = (F.col("party") == "berlinre") & (F.col("month") == "1995-02")
    close = figures.select("party", "month", F.when(silent, 0.0).otherwise(stated).alias("accounting_premium"))
    # Two accounting rows finance knows nothing of.
    extra = monthly.sparkSession.createDataFrame(
        [("getland", "2010-01", 100.0), ("dronant", "2010-02", -50.0)],
        "party string, month string, accounting_premium double",
    )
    return close.unionByName(extra)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts from ``customer`` and the first and last order of each."""
    spans = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").cast("date").alias("acquisition_date"), F.max("o_orderdate").cast("date").alias("_last"))
    )
    key = F.col("c_custkey")
    started = F.date_add("acquisition_date", (key % 30).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_mktsegment")
        .join(spans, "c_custkey")
        .select(
            key.cast("string").alias("user_id"),
            "acquisition_date",
            started.alias("started_at"),
            F.when(key % 3 == 0, F.lit(None).cast("date"))
            .when(key % 17 == 0, F.date_sub(started, 1))
            .otherwise(F.col("_last"))
            .alias("churned_at"),
            (5 + (key % 2000) / F.lit(100.0)).alias("monthly_premium"),
            F.lower("c_mktsegment").alias("product_group"),
        )
    )


def customer_feed(contracts: DataFrame) -> DataFrame:
    """The contracts with a change time: every tenth closed contract was corrected later."""
    changed = (F.col("user_id").cast("bigint") % 10 == 0) & F.col("churned_at").isNotNull()
    return contracts.withColumn(
        "updated_at",
        F.when(changed, F.lit("2001-08-02")).otherwise(F.lit("2001-08-01")).cast("timestamp_ntz"),
    )


def contract_changes(contracts: DataFrame) -> DataFrame:
    """New end dates: thirty days after the start, for the corrected contracts."""
    return customer_feed(contracts).where(F.col("updated_at") > F.lit("2001-08-01").cast("timestamp_ntz")).select(
        "user_id", F.date_add("started_at", 30).alias("new_end")
    )


def contracts_later(contracts: DataFrame, changes: DataFrame) -> DataFrame:
    """A later state of the contracts: corrected ends, some gone, some repriced, some moved to another group, some new."""
    key = F.col("user_id").cast("bigint")
    later = apply_contract_changes(contracts, changes).where(key % 23 != 0).withColumns(
        {
            "monthly_premium": F.when(key % 31 == 0, F.col("monthly_premium") + 1).otherwise(F.col("monthly_premium")),
            "product_group": F.when(key % 37 == 0, "moved").otherwise(F.col("product_group")),
        }
    )
    return later.unionByName(contracts.where(key % 41 == 0).withColumn("user_id", F.concat("user_id", F.lit("n"))))


def silver_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with fixed load times, as the history takes it."""
    at = F.lit("2001-08-01 01:00:00").cast("timestamp_ntz")
    return silver(spark, sf_dir).withColumns({"_bronze_ingested_at": at, "_silver_transformed_at": at})


def silver_next(rows: DataFrame, with_deletes: bool = True) -> DataFrame:
    """A later state of the transactions: some refunded, some repriced, some gone."""
    key = F.col("transaction_id").cast("bigint")
    later = rows.withColumns(
        {
            "status": F.when(key % 13 == 0, "refunded").otherwise(F.col("status")),
            "status_raw": F.when(key % 13 == 0, "refunded").otherwise(F.col("status_raw")),
            "premium_amount": F.when(key % 17 == 0, F.col("premium_amount") + 1).otherwise(F.col("premium_amount")),
            "_silver_transformed_at": F.lit("2001-08-02 01:00:00").cast("timestamp_ntz"),
        }
    )
    return later.where(key % 19 != 0) if with_deletes else later
