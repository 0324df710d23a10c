"""Type-2 operators over orders: priority plays the part of an address name.

Orders before 2000 are the stored versions, the newest of a customer and
priority being current; later orders are the staged rows.
"""

from pyspark.sql import functions as F

from ..functions import OPEN_END, timestamp_literal, void_flag
from ..operators import (
    Scd2Layout,
    content_anti_join,
    expire,
    find_hot_keys,
    first_match,
    initial_load,
    lookup_overlay,
    match_one,
    new_versions,
    overlay,
    project,
    registry_base,
    role_keys,
    scd2_merge,
)
from ..operators.joins import MATCH
from .joins import registry
from .registry import BATCH_TS, TestTables, plain_times, query

NATURAL_KEY = ["customer_id", "addr_name"]
SPLIT = "2000-01-01 00:00:00"
LAYOUT = Scd2Layout(
    natural_key=NATURAL_KEY,
    content=["line1", "line2"],
    surrogate="address_key",
    parent="customer_key",
    parent_id="customer_id",
    begin="begin_dt",
    end="end_dt",
    current="current_ind",
    version="version_nbr",
    void="void_ind",
    ins_batch="ins_batch",
    upd_batch="upd_batch",
)
WIDE_LAYOUT = Scd2Layout(**{**LAYOUT.__dict__, "content": ["line1", "line2", "amount"]})

# Stored versions, staged rows (one per key) and parents as SQL.
STORED = """
o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS back
      FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
stored AS (
  SELECT o_orderkey AS address_key, o_custkey + 100000 AS customer_key, o_custkey AS customer_id, o_orderpriority AS addr_name,
         o_orderstatus AS line1, CASE WHEN o_totalprice > 300000 THEN 'H' WHEN o_totalprice > 150000 THEN 'M' END AS line2,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS amount, o_orderdate AS begin_dt,
         CASE WHEN back = 1 THEN TIMESTAMP '2099-12-31' WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY
              ELSE o_orderdate + INTERVAL 30 DAY END AS end_dt,
         CAST(back = 1 AS INTEGER) AS current_ind, CAST(year(o_orderdate) - 1990 AS INTEGER) AS version_nbr,
         CAST(0 AS INTEGER) AS void_ind, CAST(1 AS BIGINT) AS ins_batch, CAST(1 AS BIGINT) AS upd_batch,
         substr(o_orderpriority, 1, 1) AS privacy
  FROM o),
cur AS (SELECT * FROM stored WHERE current_ind = 1)
"""
STAGED_ROWS = """
SELECT o_custkey AS customer_id, o_orderpriority AS addr_name, o_orderstatus AS line1,
       CASE WHEN o_totalprice > 300000 THEN 'H' WHEN o_totalprice > 150000 THEN 'M' END AS line2,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS amount, o_orderkey AS source_nbr
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
"""
STAGED = f"""
s AS ({STAGED_ROWS}),
staged AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, addr_name ORDER BY source_nbr) AS rn FROM s) WHERE rn = 1)
"""
PARENTS = """
parents AS (SELECT c_custkey AS customer_id, c_custkey + 100000 AS customer_key FROM customer WHERE c_mktsegment <> 'BUILDING')
"""


def stored_versions(t):
    old = t.orders.where(F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz"))
    rows = project(
        old,
        {
            "address_key": "o_orderkey",
            "customer_key": F.col("o_custkey") + 100000,
            "customer_id": "o_custkey",
            "addr_name": "o_orderpriority",
            **content(),
            "begin_dt": "o_orderdate",
        },
    )
    newest = first_match(
        rows.select(*NATURAL_KEY, "begin_dt", "address_key"), NATURAL_KEY, ["begin_dt", "address_key"], latest=True
    ).select(*NATURAL_KEY, F.col("address_key").alias("newest"))
    is_newest = F.col(f"{MATCH}.newest") == F.col("address_key")
    return match_one(
        rows, newest, NATURAL_KEY, unique=True, hot=find_hot_keys(rows, NATURAL_KEY)
    ).select(
        *rows.columns,
        F.when(is_newest, timestamp_literal(OPEN_END, "timestamp_ntz"))
        .when(F.col("line1") == "P", F.col("begin_dt") - F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("begin_dt") + F.expr("INTERVAL 30 DAY"))
        .alias("end_dt"),
        F.when(is_newest, 1).otherwise(0).alias("current_ind"),
        (F.year("begin_dt") - 1990).alias("version_nbr"),
        F.lit(0).alias("void_ind"),
        F.lit(1).cast("bigint").alias("ins_batch"),
        F.lit(1).cast("bigint").alias("upd_batch"),
        F.substring("addr_name", 1, 1).alias("privacy"),
    )


def content():
    price = F.col("o_totalprice")
    return {
        "line1": "o_orderstatus",
        "line2": F.when(price > 300000, "H").when(price > 150000, "M"),
        "amount": F.floor(price / 1000),
    }


def staged_rows(t):
    new = t.orders.where(F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp_ntz"))
    return project(
        new,
        {"customer_id": "o_custkey", "addr_name": "o_orderpriority", **content(), "source_nbr": "o_orderkey"},
    )


def parents(t):
    rows = t.customer.where(F.col("c_mktsegment") != "BUILDING")
    return project(rows, {"customer_id": "c_custkey", "customer_key": F.col("c_custkey") + 100000})


def current(rows):
    return rows.where(F.col("current_ind") == 1)


@query(f"WITH {STORED} SELECT * FROM cur WHERE addr_name = '1-URGENT'")
def filter_role_current(spark, sf):
    rows = stored_versions(TestTables(spark, sf))
    return rows.where((F.col("addr_name") == "1-URGENT") & (F.col("current_ind") == 1))


@query(f"""
WITH {STORED}, {STAGED}
SELECT c.* REPLACE (s.line1 AS line1, s.line2 AS line2, s.amount AS amount), s.source_nbr
FROM cur c JOIN staged s USING (customer_id, addr_name)
""")
def lookup_overlay_current(spark, sf):
    t = TestTables(spark, sf)
    return lookup_overlay(current(stored_versions(t)), staged_rows(t), NATURAL_KEY, ["source_nbr"])


@query(f"""
WITH {STORED}, {STAGED}
SELECT c.*, s.source_nbr FROM cur c JOIN staged s USING (customer_id, addr_name)
""")
def lookup_reverse_overlay(spark, sf):
    t = TestTables(spark, sf)
    return lookup_overlay(current(stored_versions(t)), staged_rows(t), NATURAL_KEY, ["source_nbr"], winner="rows")


@query(f"""
WITH {STORED}, {STAGED}
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.line1 IS NOT DISTINCT FROM s.line1
   AND t.line2 IS NOT DISTINCT FROM s.line2 AND t.amount IS NOT DISTINCT FROM s.amount)
""")
def content_anti_join_global(spark, sf):
    t = TestTables(spark, sf)
    rows, columns = staged_rows(t), WIDE_LAYOUT.content
    return content_anti_join(
        rows, stored_versions(t), columns, scope="global", hot=find_hot_keys(rows, columns)
    )


@query(f"""
WITH {STORED}, {STAGED}
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM cur t WHERE t.customer_id = s.customer_id AND t.addr_name = s.addr_name
   AND t.line1 IS NOT DISTINCT FROM s.line1 AND t.line2 IS NOT DISTINCT FROM s.line2)
""")
def content_anti_join_key(spark, sf):
    t = TestTables(spark, sf)
    return content_anti_join(staged_rows(t), current(stored_versions(t)), LAYOUT.content, NATURAL_KEY)


@query(f"""
WITH {STORED}, {STAGED}
SELECT s.customer_id, s.addr_name, s.source_nbr, CASE WHEN c.customer_id IS NULL THEN 0 ELSE c.version_nbr + 1 END AS version_nbr
FROM s LEFT JOIN cur c USING (customer_id, addr_name)
""")
def version_lookup(spark, sf):
    t = TestTables(spark, sf)
    versions = current(stored_versions(t)).select(*NATURAL_KEY, (F.col("version_nbr") + 1).alias("version_nbr"))
    rows = staged_rows(t).select(*NATURAL_KEY, "source_nbr", F.lit(0).alias("version_nbr"))
    return overlay(rows, versions, NATURAL_KEY, unique=True, hot=find_hot_keys(rows, NATURAL_KEY))


@query(f"""
WITH {STORED}
SELECT * REPLACE (CAST(begin_dt > end_dt AS INTEGER) AS void_ind) FROM stored
""")
def write_back_flag(spark, sf):
    return stored_versions(TestTables(spark, sf)).withColumn("void_ind", void_flag("begin_dt", "end_dt"))


@query("""
WITH k AS (
  SELECT o_custkey, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS ship,
         max(o_orderkey) FILTER (o_orderpriority = '2-HIGH') AS bill, max(o_orderkey) FILTER (o_orderpriority = '3-MEDIUM') AS mkt
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL
)
SELECT c_custkey, coalesce(ship, 999999999999) AS primary_key, coalesce(bill, ship, 999999999999) AS billing_key,
       coalesce(mkt, 999999999999) AS marketing_key,
       CASE WHEN o_custkey IS NULL THEN CAST(1 AS BIGINT) ELSE 20191122100000 END AS upd_batch
FROM customer LEFT JOIN k ON c_custkey = o_custkey
""")
def role_keys_fallback(spark, sf):
    return keyed_by_role(spark, sf)


@query("""
WITH r AS (
  SELECT o_custkey, o_orderpriority, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders
), k AS (
  SELECT o_custkey, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS ship,
         max(o_orderkey) FILTER (o_orderpriority = '2-HIGH') AS bill, max(o_orderkey) FILTER (o_orderpriority = '3-MEDIUM') AS mkt
  FROM r WHERE rn = 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL
)
SELECT c_custkey, coalesce(ship, 999999999999) AS primary_key, coalesce(bill, ship, 999999999999) AS billing_key,
       coalesce(mkt, 999999999999) AS marketing_key,
       CASE WHEN o_custkey IS NULL THEN CAST(1 AS BIGINT) ELSE 20191122100000 END AS upd_batch
FROM customer LEFT JOIN k ON c_custkey = o_custkey
""")
def role_keys_ordered(spark, sf):
    return keyed_by_role(spark, sf, ["o_orderdate", "o_orderkey"])


def keyed_by_role(spark, sf, order_by=None):
    t = TestTables(spark, sf)
    unknown = F.lit(999999999999).cast("bigint")
    target = project(
        t.customer,
        {"c_custkey": "c_custkey", "primary_key": unknown, "billing_key": unknown, "marketing_key": unknown,
         "upd_batch": F.lit(1).cast("bigint")},
    )
    assign = {
        "primary_key": ["1-URGENT"],
        "billing_key": ["2-HIGH", "1-URGENT"],
        "marketing_key": ["3-MEDIUM"],
    }
    rows = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return role_keys(
        target, rows, "c_custkey", "o_orderkey", "o_orderpriority", assign, order_by,
        stamp={"upd_batch": F.lit(20191122100000)},
    )


# Constants of a load at BATCH_TS in SQL.
NEW = """
TIMESTAMP '2019-11-23 10:00:00' AS begin_dt, TIMESTAMP '2099-12-31' AS end_dt, CAST(1 AS INTEGER) AS current_ind,
c.version_nbr + 1 AS version_nbr, CAST(0 AS INTEGER) AS void_ind, CAST(20191122100000 AS BIGINT) AS ins_batch,
CAST(20191122100000 AS BIGINT) AS upd_batch, c.privacy
"""
BASE = "(SELECT CAST(r_regionkey AS BIGINT) * 1000000 FROM region WHERE r_name = 'EUROPE')"
TABLE = """address_key, customer_key, customer_id, addr_name, line1, line2, amount, begin_dt, end_dt, current_ind,
version_nbr, void_ind, ins_batch, upd_batch, privacy"""
CHANGED = "(s.line1 IS DISTINCT FROM c.line1 OR s.line2 IS DISTINCT FROM c.line2)"
DELTA = f"""
delta AS (
  SELECT {BASE} + row_number() OVER (ORDER BY customer_id, addr_name) AS address_key, p.customer_key,
         customer_id, addr_name, s.line1, s.line2, s.amount, {NEW}
  FROM cur c JOIN staged s USING (customer_id, addr_name) JOIN parents p USING (customer_id) WHERE {CHANGED})
"""


@query(f"""
WITH {STAGED}, {STORED}, {PARENTS}
SELECT {BASE} + row_number() OVER (ORDER BY customer_id, addr_name) AS address_key, customer_key, customer_id, addr_name,
       line1, line2, amount, TIMESTAMP '1990-01-01' AS begin_dt, TIMESTAMP '2099-12-31' AS end_dt, CAST(1 AS INTEGER) AS current_ind,
       CAST(1 AS INTEGER) AS version_nbr, CAST(0 AS INTEGER) AS void_ind, CAST(20191122100000 AS BIGINT) AS ins_batch,
       CAST(20191122100000 AS BIGINT) AS upd_batch, CAST(NULL AS VARCHAR) AS privacy
FROM staged JOIN parents USING (customer_id)
WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.customer_id = staged.customer_id AND t.addr_name = staged.addr_name)
""")
def scd2_initial(spark, sf):
    return loaded(spark, sf).rows


SUPERSEDED = """
SELECT customer_id, addr_name, line1, line2, amount, source_nbr, 'another staged row of the key is used' AS REJECT_REASON
FROM s ANTI JOIN staged USING (customer_id, addr_name, source_nbr)
"""


@query(f"""
WITH {STAGED}, {STORED}, {PARENTS}
SELECT staged.*, 'customer_key not found' AS REJECT_REASON
FROM staged ANTI JOIN parents USING (customer_id)
WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.customer_id = staged.customer_id AND t.addr_name = staged.addr_name)
UNION ALL {SUPERSEDED}
""")
def scd2_initial_rejects(spark, sf):
    return loaded(spark, sf).rejected


def loaded(spark, sf):
    t = TestTables(spark, sf)
    rows = staged_rows(t)
    return initial_load(
        rows, stored_versions(t), parents(t), registry_base(registry(t), "EUROPE"), BATCH_TS, LAYOUT, ["source_nbr"],
        parents_unique=True, hot_parents=find_hot_keys(rows, ["customer_id"]),
    )


@query(f"""
WITH {STORED}, {STAGED}
SELECT t.* REPLACE (
  CAST(t.begin_dt > t.end_dt AS INTEGER) AS void_ind,
  CASE WHEN s.customer_id IS NOT NULL AND t.current_ind = 1 THEN TIMESTAMP '2019-11-22 10:00:00' ELSE t.end_dt END AS end_dt,
  CASE WHEN s.customer_id IS NOT NULL AND t.current_ind = 1 THEN 0 ELSE t.current_ind END AS current_ind,
  CASE WHEN s.customer_id IS NOT NULL AND t.current_ind = 1 THEN 20191122100000 ELSE t.upd_batch END AS upd_batch)
FROM stored t LEFT JOIN staged s USING (customer_id, addr_name)
""")
def scd2_expire(spark, sf):
    t = TestTables(spark, sf)
    closing = staged_rows(t).select(*NATURAL_KEY).distinct()
    return plain_times(expire(stored_versions(t), closing, LAYOUT, BATCH_TS))


@query(f"""
WITH {STORED}, {STAGED}
SELECT c.address_key, c.customer_key, customer_id, addr_name, s.line1, s.line2, s.amount, {NEW}
FROM cur c JOIN staged s USING (customer_id, addr_name) WHERE {CHANGED}
""")
def scd2_new_versions(spark, sf):
    t = TestTables(spark, sf)
    incoming = first_match(staged_rows(t), NATURAL_KEY, ["source_nbr"])
    return new_versions(current(stored_versions(t)), incoming, LAYOUT, BATCH_TS)


def merged(spark, sf, layout=LAYOUT, compat="corrected"):
    t = TestTables(spark, sf)
    rows = staged_rows(t)
    stored = stored_versions(t)
    hot = find_hot_keys(stored, NATURAL_KEY) if compat != "corrected" else None
    return scd2_merge(
        stored, rows, parents(t), registry_base(registry(t), "EUROPE"), BATCH_TS, layout, ["source_nbr"],
        compat=compat, parents_unique=True, hot=hot, hot_parents=find_hot_keys(rows, ["customer_id"]),
    )


@query(f"""
WITH {STORED}, {STAGED}, {PARENTS}, {DELTA}
SELECT t.* REPLACE (
  CAST(t.begin_dt > t.end_dt AS INTEGER) AS void_ind,
  CASE WHEN d.customer_id IS NOT NULL AND t.current_ind = 1 THEN TIMESTAMP '2019-11-22 10:00:00' ELSE t.end_dt END AS end_dt,
  CASE WHEN d.customer_id IS NOT NULL AND t.current_ind = 1 THEN 0 ELSE t.current_ind END AS current_ind,
  CASE WHEN d.customer_id IS NOT NULL AND t.current_ind = 1 THEN 20191122100000 ELSE t.upd_batch END AS upd_batch)
FROM stored t LEFT JOIN delta d ON t.customer_id = d.customer_id AND t.addr_name = d.addr_name
UNION ALL BY NAME SELECT {TABLE} FROM delta
""")
def scd2_merge_corrected(spark, sf):
    return merged(spark, sf).table


NOT_STORED = """
SELECT customer_id, addr_name, line1, line2, amount, 'no stored version' AS REJECT_REASON
FROM staged ANTI JOIN stored USING (customer_id, addr_name)
"""


@query(f"""
WITH {STORED}, {STAGED}, {PARENTS}
SELECT customer_id, addr_name, s.line1, s.line2, s.amount, 'customer_key not found' AS REJECT_REASON
FROM cur c JOIN staged s USING (customer_id, addr_name) ANTI JOIN parents p USING (customer_id) WHERE {CHANGED}
UNION ALL {NOT_STORED}
UNION ALL SELECT * EXCLUDE (source_nbr) FROM ({SUPERSEDED})
""")
def scd2_merge_rejects(spark, sf):
    return merged(spark, sf).rejected.select("customer_id", "addr_name", "line1", "line2", "amount", "REJECT_REASON")


@query(f"""
WITH {STORED}, {STAGED}
{NOT_STORED}
UNION ALL
SELECT customer_id, addr_name, s.line1, s.line2, s.amount, NULL FROM cur c JOIN staged s USING (customer_id, addr_name) WHERE NOT {CHANGED}
""")
def scd2_unmatched(spark, sf):
    """Staged rows that a merge has no use for: keys not stored, and rows that change nothing."""
    found = merged(spark, sf)
    columns = ["customer_id", "addr_name", "line1", "line2", "amount"]
    unknown = found.rejected.where("REJECT_REASON = 'no stored version'").select(*columns, "REJECT_REASON")
    return unknown.unionByName(found.unchanged.select(*columns, F.lit(None).cast("string").alias("REJECT_REASON")))


@query(f"""
WITH {STORED}, {STAGED}, {PARENTS},
closed AS (SELECT * REPLACE (CAST(CASE WHEN addr_name IN ('1-URGENT', '2-HIGH') THEN 0 ELSE current_ind END AS INTEGER) AS current_ind) FROM stored),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, addr_name ORDER BY version_nbr DESC, address_key DESC) AS rn
           FROM closed WHERE addr_name IN ('1-URGENT', '2-HIGH')) WHERE rn = 1),
next AS (SELECT customer_id, addr_name, s.line1, s.line2, s.amount, {NEW} FROM closed c JOIN staged s USING (customer_id, addr_name)
         WHERE c.current_ind = 1 AND {CHANGED}
         UNION ALL SELECT customer_id, addr_name, s.line1, s.line2, s.amount, {NEW} FROM latest c JOIN staged s USING (customer_id, addr_name))
SELECT {BASE} + row_number() OVER (ORDER BY customer_id, addr_name) AS address_key, p.customer_key, next.*
FROM next JOIN parents p USING (customer_id)
""")
def scd2_reopen(spark, sf):
    """Keys whose versions are all closed get a new one after the last."""
    t = TestTables(spark, sf)
    rows, stored = staged_rows(t), stored_versions(t)
    gone = F.col("addr_name").isin("1-URGENT", "2-HIGH")
    stored = stored.withColumn("current_ind", F.when(gone, 0).otherwise(F.col("current_ind")))
    return scd2_merge(
        stored, rows, parents(t), registry_base(registry(t), "EUROPE"), BATCH_TS, LAYOUT, ["source_nbr"], parents_unique=True
    ).added


@query(f"""
WITH {STORED}, {PARENTS},
s AS (SELECT * REPLACE (CASE WHEN source_nbr % 4 <> 0 THEN source_nbr END AS source_nbr) FROM ({STAGED_ROWS})),
staged AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, addr_name
             ORDER BY source_nbr DESC NULLS LAST, line1 DESC, line2 DESC NULLS LAST, amount DESC) AS rn FROM s) WHERE rn = 1),
{DELTA}
SELECT {TABLE} FROM delta
""")
def scd2_merge_latest(spark, sf):
    """Of several staged rows the last one; one without a number only where there is no other."""
    t = TestTables(spark, sf)
    number = F.when(F.col("source_nbr") % 4 != 0, F.col("source_nbr"))
    rows = staged_rows(t).withColumn("source_nbr", number)
    return scd2_merge(
        stored_versions(t), rows, parents(t), registry_base(registry(t), "EUROPE"), BATCH_TS, LAYOUT, ["source_nbr"],
        latest=True, parents_unique=True,
    ).added


def reference_sql(unseen):
    return f"""
WITH {STORED}, {STAGED}, {PARENTS},
numbered AS (SELECT *, {BASE} + row_number() OVER (ORDER BY customer_id, addr_name) AS address_key FROM staged),
delta AS (
  SELECT s.address_key, p.customer_key, customer_id, addr_name, s.line1, s.line2, s.amount, {NEW}
  FROM cur c JOIN numbered s USING (customer_id, addr_name) JOIN parents p USING (customer_id) WHERE {unseen})
SELECT t.* REPLACE (
  CAST(t.begin_dt > t.end_dt AS INTEGER) AS void_ind,
  CASE WHEN d.customer_id IS NOT NULL THEN TIMESTAMP '2019-11-22 10:00:00' ELSE t.end_dt END AS end_dt,
  CASE WHEN d.customer_id IS NOT NULL THEN 0 ELSE t.current_ind END AS current_ind,
  CASE WHEN d.customer_id IS NOT NULL THEN 20191122100000 ELSE t.upd_batch END AS upd_batch)
FROM stored t LEFT JOIN staged d ON t.customer_id = d.customer_id AND t.addr_name = d.addr_name
UNION ALL BY NAME SELECT {TABLE} FROM delta
"""


@query(reference_sql("""NOT EXISTS (SELECT 1 FROM stored t WHERE t.line1 IS NOT DISTINCT FROM s.line1
   AND t.line2 IS NOT DISTINCT FROM s.line2 AND t.amount IS NOT DISTINCT FROM s.amount)"""))
def scd2_merge_reference(spark, sf):
    return merged(spark, sf, WIDE_LAYOUT, "reference").table


@query(reference_sql("true"))
def scd2_merge_without_compare(spark, sf):
    return merged(spark, sf, LAYOUT, "reference_without_compare").table
