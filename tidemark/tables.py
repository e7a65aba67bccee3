"""Concrete silver tables."""

from __future__ import annotations

from tidemark.spec import TableSpec, register

# Cash transaction history: one row per transaction, partitioned by local transaction day,
# files laid out by account.
CASH_TRANSACTIONS = register(
    TableSpec(
        name="cash_transactions",
        keys=("PK_CASH_TRANSACTION",),
        partition="C_TRANSACTION_DATE_PARTITION",
        partition_source="C_TRANSACTION_DATE",
        required=("C_TRANSACTION_DATE", "PK_CASH_TRANSACTION"),
        sort_cols=("C_ACCOUNT_CODE",),
        cluster_cols=("C_ACCOUNT_CODE",),
        lookup_key="C_CUSTOMER_CODE",
    )
)
