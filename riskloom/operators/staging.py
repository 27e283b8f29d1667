"""Staging: names only, values and unlisted columns pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Raw name -> staged name.
TRANSACTION_NAMES = {
    "TransactionID": "transaction_id",
    "TransactionDT": "transaction_dt",
    "TransactionAmt": "transaction_amt",
    "ProductCD": "product_cd",
    "isFraud": "is_fraud",
    "P_emaildomain": "purchaser_email_domain",
    "R_emaildomain": "recipient_email_domain",
}
IDENTITY_NAMES = {
    "TransactionID": "transaction_id",
    "DeviceType": "device_type",
    "DeviceInfo": "device_info",
}


def stg_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(TRANSACTION_NAMES)


def stg_identity(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(IDENTITY_NAMES)


def register_views(transactions: DataFrame, identity: DataFrame) -> None:
    """Staging models are views: nothing is stored and a change of the raw table shows at once."""
    stg_transactions(transactions).createOrReplaceTempView("stg_transactions")
    stg_identity(identity).createOrReplaceTempView("stg_identity")
