"""Payment outcomes and risk by method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import ratio, rounded_percent, sum_cents, to_amount
from tillmetrics.functions.labels import RISKY_PAYMENT, risk_category
from tillmetrics.plans import REFERENCE, Tables, is_corrected


def _method_status(tables: Tables) -> DataFrame:
    risk = F.col("risk_score")
    return (
        tables["payments"]
        .groupBy("payment_method", "payment_status")
        .agg(
            F.count("*").alias("transaction_count"),
            sum_cents("amount").alias("amount_cents"),
            F.count("amount").alias("priced"),
            F.avg(risk).alias("avg_risk_score"),
            F.sum(risk).alias("risk_sum"),
            F.count(risk).alias("risk_count"),
            F.sum(F.when(risk > RISKY_PAYMENT, 1).otherwise(0)).alias("high_risk_count"),
        )
    )


def payment_method_status(tables: Tables) -> DataFrame:
    """Payments, amounts and risk per method and outcome.

    The mean risk keeps nine places; beyond them it varies with the order of addition.
    """
    return _method_status(tables).select(
        "payment_method",
        "payment_status",
        "transaction_count",
        to_amount("amount_cents").alias("total_amount"),
        ratio(to_amount("amount_cents"), F.col("priced")).alias("avg_transaction_amount"),
        F.round("avg_risk_score", 9).alias("avg_risk_score"),
        "high_risk_count",
    )


def payment_risk(tables: Tables, mode: str = REFERENCE) -> DataFrame:
    """Outcomes, processed amount, failure rate and risk label per payment method.

    The customary risk is the mean of the outcomes' means, whatever their size;
    the corrected one is the mean over all payments. The processed amount
    includes failed and refunded payments.
    """
    if is_corrected(mode):
        risk = ratio(F.sum("risk_sum"), F.sum("risk_count"))
    else:
        risk = F.avg("avg_risk_score")

    def transactions(status: str):
        chosen = F.when(F.col("payment_status") == status, F.col("transaction_count"))
        return F.sum(chosen.otherwise(0))

    by_method = (
        _method_status(tables)
        .groupBy("payment_method")
        .agg(
            transactions("completed").alias("successful_transactions"),
            transactions("failed").alias("failed_transactions"),
            transactions("refunded").alias("refunded_transactions"),
            to_amount(F.sum("amount_cents")).alias("total_processed_amount"),
            risk.alias("risk"),
        )
    )
    failed = F.col("failed_transactions")
    return by_method.select(
        "payment_method",
        "successful_transactions",
        "failed_transactions",
        "refunded_transactions",
        "total_processed_amount",
        rounded_percent(failed, F.col("successful_transactions") + failed).alias(
            "failure_rate_percent"
        ),
        F.round("risk", 3).alias("avg_risk_score"),
        risk_category(F.col("risk")).alias("risk_category"),
    ).orderBy(F.desc_nulls_last("total_processed_amount"), "payment_method")
