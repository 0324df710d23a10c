"""Purge and merge marking on customers, with events as the history feed."""

from pyspark.sql import functions as F

from ..functions import constant
from ..operators import project
from ..plans import jobs
from ..plans.layout import ACCOUNT, DELETED_ACCOUNT, MERGE_RECORD, PURGE_RECORD
from .registry import BATCH_TS, TestTables, query


def history(events):
    """Errors as purges and signups as merges, as an extract of text columns."""
    return project(
        events,
        {
            ACCOUNT: F.col("user_id").cast("string"),
            DELETED_ACCOUNT: F.col("event_id").cast("string"),
            "RECORD_TYPE": F.when(F.col("event_type") == "error", PURGE_RECORD)
            .when(F.col("event_type") == "signup", MERGE_RECORD)
            .otherwise(F.col("event_type")),
            "ROW_CREATED_DATE": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        },
    )


MARKED = """
SELECT c_custkey AS CUSTOMER_ID, c_name AS LAST_NAME, p.ts AS PURGED_DT, CAST(p.user_id IS NOT NULL AS INTEGER) AS PURGED_IND,
       m.event_id AS MERGED_SOURCE_ACCT_ID, m.ts AS MERGED_DT, CAST(m.user_id IS NOT NULL AS INTEGER) AS MERGED_IND,
       CASE WHEN p.user_id IS NULL AND m.user_id IS NULL THEN CAST(1 AS BIGINT) ELSE 20191122100000 END AS UPD_BATCH_NBR
FROM customer LEFT JOIN p ON c_custkey = p.user_id LEFT JOIN m ON c_custkey = m.user_id
"""


@query(f"""
WITH p AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'error' GROUP BY ALL),
     m AS (SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM events WHERE event_type = 'signup' GROUP BY ALL)
{MARKED}""")
def purge_merge_mark(spark, sf):
    t = TestTables(spark, sf)
    return jobs.history_marked(unmarked(t), history(t.events), batch_ts=BATCH_TS)


@query(f"""
WITH e AS (SELECT * REPLACE (CASE WHEN event_id % 3 <> 0 THEN ts END AS ts) FROM events),
     p AS (SELECT user_id, max(ts) AS ts FROM e WHERE event_type = 'error' GROUP BY ALL),
     m AS (SELECT user_id, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
           FROM e WHERE event_type = 'signup') WHERE rn = 1)
{MARKED}""")
def purge_merge_latest(spark, sf):
    """A third of the events has no time; such a one counts only where there is no other."""
    t = TestTables(spark, sf)
    undated = history(t.events).withColumn(
        "ROW_CREATED_DATE", F.when(F.col(DELETED_ACCOUNT).cast("bigint") % 3 != 0, F.col("ROW_CREATED_DATE"))
    )
    return jobs.history_marked(unmarked(t), undated, batch_ts=BATCH_TS)


def unmarked(t):
    return project(
        t.customer,
        {
            "CUSTOMER_ID": "c_custkey",
            "LAST_NAME": "c_name",
            "PURGED_DT": constant(None, "timestamp_ntz"),
            "PURGED_IND": F.lit(0),
            "MERGED_SOURCE_ACCT_ID": constant(None, "bigint"),
            "MERGED_DT": constant(None, "timestamp_ntz"),
            "MERGED_IND": F.lit(0),
            "UPD_BATCH_NBR": constant(1, "bigint"),
        },
    )
