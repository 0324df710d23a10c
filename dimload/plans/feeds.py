"""Staged extracts as typed feeds for the targets.

A feed has only the columns it brings. What it leaves out is left to the
overlay, so the target keeps it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    area_code,
    batch_number,
    blank_to_zero,
    indicator,
    parse_compact,
    text_to_long,
    text_to_timestamp,
    timestamp_literal,
    unknown_key,
    zip4,
    zip5,
)
from ..operators.shape import project
from .layout import (
    ACCOUNT,
    ADDRESS_COPIES,
    ADDRESS_FLAGS,
    CONTACT_COPIES,
    CONTACT_COUNTS,
    CONTACT_FLAGS,
    DELETED_ACCOUNT,
    MERGE_RECORD,
    NEW_CUSTOMER_UNKNOWN_KEYS,
    NEW_CUSTOMER_ZEROES,
    ORGANISATION_COPIES,
    PURGE_RECORD,
    SOURCE_SYSTEM,
)

UPDATED = "UPD_BATCH_NBR"
INSERTED = "INS_BATCH_NBR"


def batch(batch_ts: str | datetime) -> Column:
    return batch_number(timestamp_literal(batch_ts))


def stamp(df: DataFrame, batch_ts: str | datetime, insert: bool = False) -> DataFrame:
    """Mark rows with the load's batch number, as updated or also as inserted."""
    df = df.withColumn(UPDATED, batch(batch_ts))
    return df.withColumn(INSERTED, batch(batch_ts)) if insert else df


def _renamed(copies: dict[str, str]) -> dict[str, str]:
    return {target: staged for staged, target in copies.items()}


def organisation_feed(staged: DataFrame, batch_ts: str | datetime) -> DataFrame:
    feed = project(
        staged,
        {
            "CUSTOMER_ID": text_to_long(ACCOUNT),
            "SOURCE_CREATE_DT": text_to_timestamp("ROW_CREATED_DATE"),
            "DERIVED_AREA_CODE": area_code("PRIMARY_PHONE_NUM"),
            "BILLSHIP_ADDR_SYNC_IND": blank_to_zero("BILL_SHIP_ADDR_SYNC_FLAG"),
            **_renamed(ORGANISATION_COPIES),
        },
    )
    return stamp(feed, batch_ts)


def contact_feed(staged: DataFrame, batch_ts: str | datetime | None) -> DataFrame:
    """``batch_ts=None`` leaves the batch number out."""
    feed = project(
        staged,
        {
            "CUSTOMER_ID": text_to_long(ACCOUNT),
            **_renamed(CONTACT_COPIES),
            **{ind: indicator(flag) for flag, ind in CONTACT_FLAGS.items()},
            **{count: text_to_long(text) for text, count in CONTACT_COUNTS.items()},
        },
    )
    return feed if batch_ts is None else stamp(feed, batch_ts)


def purge_feed(history: DataFrame) -> DataFrame:
    return project(
        history.where(F.col("RECORD_TYPE") == PURGE_RECORD),
        {"CUSTOMER_ID": text_to_long(ACCOUNT), "PURGED_DT": text_to_timestamp("ROW_CREATED_DATE"), "PURGED_IND": F.lit(1)},
    )


def merge_feed(history: DataFrame, source: str = "deleted") -> DataFrame:
    """Merged accounts. ``source`` says which account is marked with which.

    ``deleted``   the surviving account is marked with the one merged away
    ``survivor``  the account merged away is marked with the surviving one
    ``same``      the account is marked with itself
    """
    key, origin = {
        "deleted": (ACCOUNT, DELETED_ACCOUNT),
        "survivor": (DELETED_ACCOUNT, ACCOUNT),
        "same": (ACCOUNT, ACCOUNT),
    }[source]
    return project(
        history.where(F.col("RECORD_TYPE") == MERGE_RECORD),
        {
            "CUSTOMER_ID": text_to_long(key),
            "MERGED_SOURCE_ACCT_ID": text_to_long(origin),
            "MERGED_DT": text_to_timestamp("ROW_CREATED_DATE"),
            "MERGED_IND": F.lit(1),
        },
    )


def new_customers(staged: DataFrame, batch_ts: str | datetime) -> DataFrame:
    """An organisation extract as complete new customers, but for their key."""
    feed = organisation_feed(staged, batch_ts)
    constants = {
        "ETL_SOURCE_SYSTEM": F.lit(SOURCE_SYSTEM),
        **{c: unknown_key() for c in NEW_CUSTOMER_UNKNOWN_KEYS},
        **{c: F.lit(0) for c in NEW_CUSTOMER_ZEROES},
    }
    return stamp(feed.withColumns(constants), batch_ts, insert=True)


def address_feed(
    staged: DataFrame, created: str = "compact", effective: str | None = None
) -> DataFrame:
    """An address extract with its natural key and content columns.

    ``created`` tells how the creation time is written: ``compact`` digits or
    ``timestamp`` text. ``effective`` also keeps that staged column.
    """
    created_at = {"compact": parse_compact, "timestamp": text_to_timestamp}[created]
    return project(
        staged,
        {
            "CUSTOMER_ID": text_to_long(ACCOUNT),
            "ADDR_NAME": "ADDRESS_NAME",
            "ETL_SOURCE_SYSTEM": F.lit(SOURCE_SYSTEM),
            "SOURCE_CREATE_DT": created_at("ROW_CREATED_DATE"),
            **_renamed(ADDRESS_COPIES),
            "POSTAL_ZIP": zip5("ZIP_CODE"),
            "POSTAL_ZIP4": zip4("ZIP_CODE"),
            **{ind: indicator(flag, yes) for flag, (ind, yes) in ADDRESS_FLAGS.items()},
            **({effective: effective} if effective else {}),
        },
    )
