"""The loads, table to table, on scratch tables with all columns, filled from the test tables.

Which staged column fills which target column is written out twice, here by staged
and below by target name, so that a swapped pair shows.
"""

from dataclasses import fields

from pyspark.sql import functions as F

from ..operators import align, project
from ..plans import Tables
from ..plans import jobs as loads
from ..plans.layout import (
    ACCOUNT,
    ADDRESS_SCHEMA,
    BILLING,
    CUSTOMER_SCHEMA,
    MARKETING,
    NEW_CUSTOMER_UNKNOWN_KEYS,
    NEW_CUSTOMER_ZEROES,
    SHIPPING,
)
from ..sources import cut_lineage
from .customers import history
from .registry import BATCH_TS, TestTables, plain_times, query, scratch_database

FIRST_BATCH = "2019-11-20 10:00:00"
CUSTOMER_BASE, ADDRESS_BASE = 3000000, 2000000


class Scratch:
    """The tables of the loads, in a database of their own."""

    def __init__(self, spark, sf):
        self.spark, self.t = spark, TestTables(spark, sf)
        self.database = scratch_database(spark)
        place = {f.name: f"{self.database}.{f.default}" for f in fields(Tables) if not f.name.endswith("registry_name")}
        self.tables = Tables(**place)
        names = [(self.tables.customer_registry_name, CUSTOMER_BASE), (self.tables.address_registry_name, ADDRESS_BASE)]
        self.put("registry", spark.createDataFrame(names, "TABLE_NAME string, MAX_VALUE_KEY long"))
        self.put("address_dim", spark.createDataFrame([], ADDRESS_SCHEMA))

    def put(self, table, rows):
        rows.write.mode("overwrite").saveAsTable(getattr(self.tables, table))
        return self

    def result(self, table):
        """The rows of a table, written apart; the database is dropped."""
        rows = cut_lineage(plain_times(self.spark.table(getattr(self.tables, table))))
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        return rows


def text(name, key):
    return F.concat(F.lit(name + "|"), F.col(key).cast("string"))


ORGANISATION_TEXTS = [
    "GUEST_CUSTOMER_FLAG", "GUID", "MARKET_PLACE_ID", "MARKET_PLACE_CUSTID", "PRIMARY_PHONE_TYPE", "ALT_PHONE1_NUMBER",
    "ALT_PHONE1_TYPE", "ALT_PHONE2_NUMBER", "ALT_PHONE2_TYPE",
]


def organisation(customers):
    """Customers as an organisation extract, all text."""
    digits = F.substring("c_name", 10, 9)
    return project(
        customers,
        {
            ACCOUNT: F.col("c_custkey").cast("string"),
            "ROW_CREATED_DATE": F.lit("2019-10-01 08:00:00"),
            "BILL_SHIP_ADDR_SYNC_FLAG": F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise("1"),
            "PRIMARY_PHONE_NUM": F.concat(F.substring("c_name", 16, 3), digits),
            **{c: text(c, "c_name") for c in ORGANISATION_TEXTS},
        },
    )


def with_stale(rows, column, *times):
    """Each row again with other times, and what it says marked: none of these is the latest."""
    out = rows
    for time in times:
        stale = rows.withColumn(column, F.lit(time).cast("string"))
        out = out.unionByName(stale.withColumn("GUID", F.lit("zzz stale")))
    return out


CONTACT_TEXTS = ["EMAIL_SOURCE_CODE", "EMAIL_ADDRESS", "LAST_EMAIL_DATE", "MEDIA_TYPE", "HSN_EMP_ID"]
CONTACT_FLAG_NUMBERS = {
    "SUPRESS_EMAIL_FLAG": 1, "SEND_NEWS_FLAG": 2, "SUPRESS_CALL_FLAG": 3, "SUPRESS_MAIL_FLAG": 4, "DIRECT_DEBIT_FLAG": 5,
    "FLEX_PAY_LIMIT_FLAG": 6, "NAT_TAX_EXEMPT_FLAG": 7, "NO_FLEXPAY_FLAG": 8, "NO_ON_AIR_FLAG": 9, "NO_REFUND_FLAG": 10,
    "NO_SHIP_ADDR_FLAG": 11, "ST_TAX_EXEMPT_FLAG": 12, "AUTOSHIP_CUST_FLAG": 13, "ABUSIVE_RETURNS_FLAG": 14, "PROMO_FLAG": 15,
}
CONTACT_COUNT_NUMBERS = {"ABUSIVE_RETURNS_COUNT": 1, "CALL_TAG_COUNT": 2, "EMPTY_BOX_COUNT": 3}


def contact(t):
    """Events as a contact extract with several rows for some customers."""
    event = F.col("event_id")

    def flag(i):
        return F.when((event * i) % 7 == 1, "Y").when((event * i) % 7 == 2, "N").when((event * i) % 7 == 3, "")

    return project(
        t.events,
        {
            ACCOUNT: F.col("user_id").cast("string"),
            "CUSTOMER_SINCE_DATE": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "FIRST_NAME": "event_type",
            "LAST_NAME": F.nullif(F.col("event_type"), F.lit("view")),
            **{c: text(c, "event_id") for c in CONTACT_TEXTS},
            **{c: flag(i) for c, i in CONTACT_FLAG_NUMBERS.items()},
            **{c: (event * i % 1000).cast("string") for c, i in CONTACT_COUNT_NUMBERS.items()},
        },
    )


def stored_customers(rows):
    return align(
        project(
            rows,
            {
                "CUSTOMER_KEY": F.col("c_custkey") + 100000,
                "CUSTOMER_ID": "c_custkey",
                "LAST_NAME": "c_name",
                "DOTCOM_EMAIL_ADDRESS": "c_mktsegment",
                "PRIMARY_PHONE_NUMBER": F.lit("none"),
                "PURGED_IND": F.lit(0),
                "MERGED_IND": F.lit(0),
                **{c: F.lit(999999999999).cast("bigint") for c in NEW_CUSTOMER_UNKNOWN_KEYS},
                "UPD_BATCH_NBR": F.lit(1).cast("bigint"),
                "INS_BATCH_NBR": F.lit(1).cast("bigint"),
            },
        ),
        CUSTOMER_SCHEMA,
    )


ADDRESS_TEXTS = ["ADDRESS_LINE_2", "STATE", "COUNTRY", "ADDRESS_TYPE_CODE", "SHIP_TO_FIRST_NAME", "SHIP_TO_LAST_NAME"]


def addresses(t, dated="true"):
    """Orders as an address extract; several rows per customer and name. ``dated`` says which orders."""
    order = F.col("o_orderkey")
    role = (
        F.when(F.col("o_orderpriority") == "1-URGENT", SHIPPING)
        .when(F.col("o_orderpriority") == "2-HIGH", BILLING)
        .when(F.col("o_orderpriority") == "3-MEDIUM", MARKETING)
        .otherwise(F.col("o_orderpriority"))
    )
    return project(
        t.orders.where(dated),
        {
            ACCOUNT: F.col("o_custkey").cast("string"),
            "ADDRESS_NAME": role,
            "ROW_CREATED_DATE": F.date_format("o_orderdate", "yyyyMMddHHmmss"),
            "ADDRESS_LINE_1": order.cast("string"),
            "CITY": "o_orderstatus",
            **{c: text(c, "o_orderkey") for c in ADDRESS_TEXTS},
            "ZIP_CODE": F.lpad(order.cast("string"), 9, "0"),
            "DISABLE_CLEANSING_FLAG": F.when(F.col("o_orderstatus") == "O", "N"),
            "FRAUD_BAD_ACCT_FLAG": F.when(order % 3 == 0, "Y").otherwise("N"),
            "AGENT_VERIFIED_ADDRESS": F.when(order % 5 == 0, "Y"),
        },
    )


# SQL: the columns of a target as expressions by name, overlaid one set by the next.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP"}
CUSTOMER_TYPES = {f.name: TYPES[f.dataType.simpleString()] for f in CUSTOMER_SCHEMA.fields}
ADDRESS_TYPES = {f.name: TYPES[f.dataType.simpleString()] for f in ADDRESS_SCHEMA.fields}
STORED = {
    "CUSTOMER_KEY": "c_custkey + 100000", "CUSTOMER_ID": "c_custkey", "LAST_NAME": "c_name", "DOTCOM_EMAIL_ADDRESS": "c_mktsegment",
    "PRIMARY_PHONE_NUMBER": "'none'", "PURGED_IND": "0", "MERGED_IND": "0", "UPD_BATCH_NBR": "1", "INS_BATCH_NBR": "1",
    "PRIMARY_ADDRESS_KEY": "999999999999", "BILLING_ADDRESS_KEY": "999999999999", "MKTADDR_ADDRESS_KEY": "999999999999",
    "IDCENTRIC_INDIVIDUAL_ID": "999999999999", "IDCENTRIC_HOUSEHOLD_ID": "999999999999", "IDCENTRIC_ADDRESS_ID": "999999999999",
}
FROM_ORGANISATION = {
    "SOURCE_CREATE_DT": "TIMESTAMP '2019-10-01 08:00:00'", "PRIMARY_PHONE_NUMBER": "substr(c_name, 16, 3) || substr(c_name, 10)",
    "DERIVED_AREA_CODE": "CAST(substr(c_name, 16, 3) AS BIGINT)",
    "BILLSHIP_ADDR_SYNC_IND": "CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END", "GUEST_CODE": "'GUEST_CUSTOMER_FLAG|' || c_name",
    "DIGITAL_CUSTOMER_ID": "'GUID|' || c_name", "MARKET_PLACE_ID": "'MARKET_PLACE_ID|' || c_name",
    "MARKET_PLACE_CUST_ID": "'MARKET_PLACE_CUSTID|' || c_name", "PRIMARY_PHONE_TYPE": "'PRIMARY_PHONE_TYPE|' || c_name",
    "ALT_PHONE1_NUMBER": "'ALT_PHONE1_NUMBER|' || c_name", "ALT_PHONE1_TYPE": "'ALT_PHONE1_TYPE|' || c_name",
    "ALT_PHONE2_NUMBER": "'ALT_PHONE2_NUMBER|' || c_name", "ALT_PHONE2_TYPE": "'ALT_PHONE2_TYPE|' || c_name",
    "UPD_BATCH_NBR": "20191122100000",
}
NEW_CUSTOMER = {
    **FROM_ORGANISATION, "CUSTOMER_ID": "c_custkey", "ETL_SOURCE_SYSTEM": "'CLIC'", "INS_BATCH_NBR": "20191122100000",
    **{c: "999999999999" for c in NEW_CUSTOMER_UNKNOWN_KEYS}, **{c: "0" for c in NEW_CUSTOMER_ZEROES},
}
FROM_CONTACT = {
    "CUSTOMER_SINCE_DT": "strftime(c.ts, '%Y-%m-%d %H:%M:%S.%f')", "FIRST_NAME": "c.event_type", "LAST_NAME": "nullif(c.event_type, 'view')",
    "CLIC_EMAIL_SOURCE_CODE": "'EMAIL_SOURCE_CODE|' || c.event_id", "CLIC_EMAIL_ADDRESS": "'EMAIL_ADDRESS|' || c.event_id",
    "CLIC_EMAIL_LAST_UPDT": "'LAST_EMAIL_DATE|' || c.event_id", "MEDIA_CODE": "'MEDIA_TYPE|' || c.event_id",
    "EMPLOYEE_ID": "'HSN_EMP_ID|' || c.event_id",
    **{
        column: f"CASE WHEN c.event_id * {i} % 7 = 1 THEN 1 ELSE 0 END"
        for column, i in {
            "SUPPRESS_EMAIL_IND": 1, "SEND_NEWS_IND": 2, "SUPPRESS_CALL_IND": 3, "SUPPRESS_MAIL_IND": 4, "BANK_DIRECT_DEBIT_IND": 5,
            "HAS_FLEXPAY_LIMIT_IND": 6, "NATIONAL_TAX_EXEMPT_IND": 7, "FLEXPAY_IND": 8, "ALLOW_ONAIR_IND": 9, "ALLOW_REFUND_IND": 10,
            "SHIP_ADDR_IND": 11, "STATE_TAX_EXEMPT_IND": 12, "AUTOSHIP_CUSTOMER_IND": 13, "ABUSIVE_RETURNS_IND": 14,
            "DYN_MSG_PROMO_IND": 15,
        }.items()
    },
    "ABUSIVE_RETURNS_CNT": "c.event_id * 1 % 1000", "CALL_TAG_CNT": "c.event_id * 2 % 1000", "EMPTY_BOX_CNT": "c.event_id * 3 % 1000",
    "UPD_BATCH_NBR": "20191122100000",
}
FROM_HISTORY = [
    ("p.user_id", {"PURGED_DT": "p.ts", "PURGED_IND": "1"}),
    ("m.user_id", {"MERGED_DT": "m.ts", "MERGED_IND": "1", "MERGED_SOURCE_ACCT_ID": "m.event_id"}),
]
STAMPED = {"UPD_BATCH_NBR": "20191122100000"}
FROM_ROLES = {
    "PRIMARY_ADDRESS_KEY": "coalesce(ship, 999999999999)", "BILLING_ADDRESS_KEY": "coalesce(bill, ship, 999999999999)",
    "MKTADDR_ADDRESS_KEY": "coalesce(mkt, 999999999999)", "UPD_BATCH_NBR": "20191122100000",
}


def columns(types, values):
    """A select list of all columns; those without a value are NULL."""
    assert set(values) <= set(types), set(values) - set(types)
    return ", ".join(f"CAST({values.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in types.items())


def laid_over(values, matched, feed):
    return {**values, **{c: f"CASE WHEN {matched} IS NOT NULL THEN {v} ELSE {values.get(c, 'NULL')} END" for c, v in feed.items()}}


LATEST = """
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1),
p AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'error' GROUP BY ALL),
m AS (SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM events WHERE event_type = 'signup' GROUP BY ALL)
"""
JOINED = """customer LEFT JOIN c ON c_custkey = c.user_id LEFT JOIN p ON c_custkey = p.user_id LEFT JOIN m ON c_custkey = m.user_id"""


@query(f"""
SELECT {columns(CUSTOMER_TYPES, {**STORED})} FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT {columns(CUSTOMER_TYPES, {"CUSTOMER_KEY": f"{CUSTOMER_BASE} + row_number() OVER (ORDER BY c_custkey)", **NEW_CUSTOMER})}
FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def job_insert_customers(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer.where("c_mktsegment = 'BUILDING'")))
    s.put("organisation", with_stale(organisation(s.t.customer), "ROW_CREATED_DATE", "2019-09-30 09:00:00", None))
    loads.insert_customers(spark, BATCH_TS, s.tables, on_duplicate="latest")
    return s.result("customer_dim")


@query(f"""
SELECT {columns(CUSTOMER_TYPES, {"CUSTOMER_KEY": f"{CUSTOMER_BASE} + row_number() OVER (ORDER BY c_custkey)", **NEW_CUSTOMER})}
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT {columns(CUSTOMER_TYPES, STORED)} FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def job_upsert_customers(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer))
    s.put("organisation", organisation(s.t.customer.where("c_mktsegment = 'BUILDING'")))
    loads.upsert_customers(spark, BATCH_TS, s.tables)
    return s.result("customer_dim")


WITHOUT_IDS = {**NEW_CUSTOMER, "CUSTOMER_ID": "CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END"}


@query(f"""
SELECT {columns(CUSTOMER_TYPES, {"CUSTOMER_KEY": f"{CUSTOMER_BASE} + row_number() OVER (ORDER BY {WITHOUT_IDS['CUSTOMER_ID']} NULLS FIRST, substr(c_name, 16, 3) || substr(c_name, 10), c_name)", **WITHOUT_IDS})}
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT {columns(CUSTOMER_TYPES, STORED)} FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey % 10 = 0
""")
def job_upsert_rerun(spark, sf):
    """The same extract three times, some customers without an id: all but the first run change nothing."""
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer))
    some = organisation(s.t.customer.where("c_mktsegment = 'BUILDING'"))
    some = some.withColumn(ACCOUNT, F.when(F.col(ACCOUNT).cast("long") % 10 != 0, F.col(ACCOUNT)))
    s.put("organisation", some)
    for batch in (BATCH_TS, "2019-11-23 10:00:00", "2019-11-24 10:00:00"):
        loads.upsert_customers(spark, batch, s.tables)
    return s.result("customer_dim")


@query(f"WITH {LATEST} SELECT {columns(CUSTOMER_TYPES, laid_over(STORED, 'c.rn', FROM_CONTACT))} FROM {JOINED}")
def job_refresh_contact(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer)).put("contact", contact(s.t))
    loads.refresh_from_contact(spark, BATCH_TS, s.tables)
    return s.result("customer_dim")


ERASED = {
    **STORED, **{c: f"CASE WHEN c.rn IS NOT NULL THEN {v} END" for c, v in FROM_CONTACT.items()},
    "DOTCOM_EMAIL_ADDRESS": "NULL", "DOTCOM_EMAIL_LAST_UPDT": "NULL", **STAMPED,
}


@query(f"WITH {LATEST} SELECT {columns(CUSTOMER_TYPES, ERASED)} FROM {JOINED}")
def job_refresh_contact_erasing(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer)).put("contact", contact(s.t))
    loads.refresh_from_contact(spark, BATCH_TS, s.tables, on_missing="null", stamp_all=True)
    return s.result("customer_dim")


KEPT = {**STORED, **{c: f"CASE WHEN c_acctbal > 0 THEN {v} END" for c, v in FROM_ORGANISATION.items()}}


@query(f"SELECT {columns(CUSTOMER_TYPES, KEPT)} FROM customer")
def job_refresh_organisation_erasing(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer))
    staged = organisation(s.t.customer.where("c_acctbal > 0"))
    s.put("organisation", with_stale(staged, "ROW_CREATED_DATE", "2019-09-30 09:00:00", None))
    loads.refresh_from_organisation(spark, BATCH_TS, s.tables, on_missing="null")
    return s.result("customer_dim")


MARKED = STORED
for found, values in FROM_HISTORY:
    MARKED = laid_over(MARKED, found, {**values, **STAMPED})


@query(f"WITH {LATEST} SELECT {columns(CUSTOMER_TYPES, MARKED)} FROM {JOINED}")
def job_mark_history(spark, sf):
    s = Scratch(spark, sf)
    s.put("customer_dim", stored_customers(s.t.customer)).put("history", history(s.t.events))
    loads.mark_history(spark, s.tables, batch_ts=BATCH_TS)
    return s.result("customer_dim")


# Orders as address rows, the latest of each customer and name.
ADDRESS = {
    "CUSTOMER_ID": "o_custkey",
    "ADDR_NAME": "CASE o_orderpriority WHEN '1-URGENT' THEN 'SHIPADDR0' WHEN '2-HIGH' THEN 'BILLADDR1' WHEN '3-MEDIUM' THEN 'MKTADDR' ELSE o_orderpriority END",
    "ETL_SOURCE_SYSTEM": "'CLIC'", "SOURCE_CREATE_DT": "o_orderdate", "ADDR_LINE1_TXT": "CAST(o_orderkey AS VARCHAR)",
    "ADDR_LINE2_TXT": "'ADDRESS_LINE_2|' || o_orderkey", "CITY_NAME": "o_orderstatus", "STATE_CODE": "'STATE|' || o_orderkey",
    "COUNTRY_CODE": "'COUNTRY|' || o_orderkey", "POSTAL_ZIP": "substr(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 1, 5)",
    "POSTAL_ZIP4": "substr(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 6)", "ADDR_CLEANSING_IND": "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END",
    "ADDR_FRAUD_IND": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END", "ADDR_QAS_VERIFIED_IND": "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END",
    "ADDR_TYPE_CODE": "'ADDRESS_TYPE_CODE|' || o_orderkey", "SHIPTO_FIRST_NAME": "'SHIP_TO_FIRST_NAME|' || o_orderkey",
    "SHIPTO_LAST_NAME": "'SHIP_TO_LAST_NAME|' || o_orderkey",
}
ADDRESS_ROWS = f"""
a AS (SELECT {", ".join(f"{v} AS {c}" for c, v in ADDRESS.items())} FROM orders),
older AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID, ADDR_NAME ORDER BY SOURCE_CREATE_DT DESC, ADDR_LINE1_TXT DESC) AS rn
          FROM a WHERE SOURCE_CREATE_DT < TIMESTAMP '2000-01-01') WHERE rn = 1),
newer AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID, ADDR_NAME ORDER BY SOURCE_CREATE_DT DESC, ADDR_LINE1_TXT DESC) AS rn
          FROM a WHERE SOURCE_CREATE_DT >= TIMESTAMP '2000-01-01') WHERE rn = 1),
loaded AS (SELECT CAST({ADDRESS_BASE} AS BIGINT) + row_number() OVER (ORDER BY CUSTOMER_ID, ADDR_NAME) AS CUSTOMER_ADDRESS_KEY,
                  CUSTOMER_ID + 100000 AS CUSTOMER_KEY, *
           FROM older WHERE CUSTOMER_ID IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'))
"""
STORED_ADDRESS = {c: f"l.{c}" for c in ("CUSTOMER_ADDRESS_KEY", "CUSTOMER_KEY", *ADDRESS)}
FIRST_VERSION = {
    **STORED_ADDRESS, "ETL_BEGIN_EFFECTIVE_DT": "TIMESTAMP '1990-01-01'", "ETL_END_EFFECTIVE_DT": "TIMESTAMP '2099-12-31'",
    "ETL_CURRENT_IND": "1", "ETL_VERSION_NBR": "1", "VOID_IND": "0", "PRIVACY_IND": "0", "INS_BATCH_NBR": "20191120100000",
    "UPD_BATCH_NBR": "20191120100000",
}


def with_addresses(spark, sf, customers, layout=""):
    """Customers stored and the older addresses loaded, into a table of that layout."""
    s = Scratch(spark, sf)
    if layout:
        spark.sql(f"DROP TABLE {s.tables.address_dim}")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ADDRESS_SCHEMA.fields)
        spark.sql(f"CREATE TABLE {s.tables.address_dim} ({kinds}) USING parquet {layout}")
    s.put("customer_dim", stored_customers(customers(s.t)))
    s.put("address", addresses(s.t, "o_orderdate < '2000-01-01'"))
    loads.insert_addresses(spark, FIRST_BATCH, s.tables, created="compact")
    return s


def not_building(t):
    return t.customer.where("c_mktsegment <> 'BUILDING'")


@query(f"WITH {ADDRESS_ROWS} SELECT {columns(ADDRESS_TYPES, FIRST_VERSION)} FROM loaded l")
def job_insert_addresses(spark, sf):
    return with_addresses(spark, sf, not_building).result("address_dim")


CLOSING = {"ETL_END_EFFECTIVE_DT": "TIMESTAMP '2019-11-22 10:00:00'", "ETL_CURRENT_IND": "0", "UPD_BATCH_NBR": "20191122100000"}
NEXT_VERSION = {
    **FIRST_VERSION, "ETL_BEGIN_EFFECTIVE_DT": "TIMESTAMP '2019-11-23 10:00:00'", "ETL_VERSION_NBR": "2",
    "INS_BATCH_NBR": "20191122100000", "UPD_BATCH_NBR": "20191122100000",
}
MERGED = f"""
WITH {ADDRESS_ROWS},
added AS (SELECT CAST({{base}} AS BIGINT) + row_number() OVER (ORDER BY CUSTOMER_ID, ADDR_NAME) AS CUSTOMER_ADDRESS_KEY,
                 CUSTOMER_ID + 100000 AS CUSTOMER_KEY, n.*
          FROM newer n SEMI JOIN loaded l USING (CUSTOMER_ID, ADDR_NAME))
SELECT {columns(ADDRESS_TYPES, laid_over(FIRST_VERSION, "d.CUSTOMER_ID", CLOSING))}
FROM loaded l LEFT JOIN added d ON l.CUSTOMER_ID = d.CUSTOMER_ID AND l.ADDR_NAME = d.ADDR_NAME
UNION ALL
SELECT {columns(ADDRESS_TYPES, NEXT_VERSION)} FROM added l
""".format(base=f"(SELECT {ADDRESS_BASE} + count(*) FROM loaded)")


@query(MERGED)
def job_scd2_addresses(spark, sf):
    s = with_addresses(spark, sf, not_building)
    s.put("address", addresses(s.t, "o_orderdate >= '2000-01-01'"))
    loads.update_addresses(spark, BATCH_TS, s.tables)
    return s.result("address_dim")


@query(MERGED)
def job_scd2_addresses_by_partition(spark, sf):
    """The same, of a table partitioned by its current flag: history is not written again."""
    s = with_addresses(spark, sf, not_building, "PARTITIONED BY (ETL_CURRENT_IND)")
    s.put("address", addresses(s.t, "o_orderdate >= '2000-01-01'"))
    loads.update_addresses(spark, BATCH_TS, s.tables)
    return s.result("address_dim").select(*ADDRESS_SCHEMA.names)


ROLE_KEYS = """
r AS (SELECT CUSTOMER_KEY, max(CUSTOMER_ADDRESS_KEY) FILTER (ADDR_NAME = 'SHIPADDR0') AS ship,
             max(CUSTOMER_ADDRESS_KEY) FILTER (ADDR_NAME = 'BILLADDR1') AS bill, max(CUSTOMER_ADDRESS_KEY) FILTER (ADDR_NAME = 'MKTADDR') AS mkt
      FROM loaded WHERE ADDR_NAME IN ('SHIPADDR0', 'BILLADDR1', 'MKTADDR') GROUP BY ALL)
"""
WITH_ROLES = "LEFT JOIN r ON c_custkey + 100000 = r.CUSTOMER_KEY"


@query(f"""
WITH {ADDRESS_ROWS}, {ROLE_KEYS}
SELECT {columns(CUSTOMER_TYPES, laid_over(STORED, "r.CUSTOMER_KEY", FROM_ROLES))}
FROM customer {WITH_ROLES} WHERE c_mktsegment <> 'BUILDING'
""")
def job_set_address_keys(spark, sf):
    s = with_addresses(spark, sf, not_building)
    loads.set_address_keys(spark, BATCH_TS, s.tables)
    return s.result("customer_dim")


EVERYTHING = laid_over({**STORED, **FROM_ORGANISATION}, "c.rn", FROM_CONTACT)
for found, values in FROM_HISTORY:
    EVERYTHING = laid_over(EVERYTHING, found, values)
EVERYTHING = laid_over(EVERYTHING, "r.CUSTOMER_KEY", FROM_ROLES)


@query(f"""
WITH {LATEST}, {ADDRESS_ROWS}, {ROLE_KEYS}
SELECT {columns(CUSTOMER_TYPES, EVERYTHING)} FROM {JOINED} {WITH_ROLES} WHERE c_mktsegment <> 'BUILDING'
""")
def job_refresh_customers(spark, sf):
    s = with_addresses(spark, sf, not_building)
    s.put("organisation", with_stale(organisation(s.t.customer), "ROW_CREATED_DATE", "2019-09-30 09:00:00", None))
    s.put("contact", contact(s.t)).put("history", history(s.t.events))
    loads.refresh_customers(spark, BATCH_TS, s.tables)
    return s.result("customer_dim")
