"""The loads: each reads its tables, computes the new rows and writes one target.

The frame-to-frame part of a load has a name of its own (``refreshed_customers``
and so on), so it can be used and tested without tables. Run order:
``insert_customers``, ``insert_addresses``, ``refresh_customers`` (or the three
single-feed refreshes), ``update_addresses``, ``set_address_keys``. Of several loads of one
table at a time one goes on, the others raise ``LeaseHeld``.

``batch_ts`` is the time of the load. Of several staged rows of one key the latest is
used: the last by the times and then the other columns named here, a row without a
time before those that have one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    Feed,
    HotKeys,
    advance_registry,
    assign_surrogate_keys,
    changed_rows,
    expire,
    find_hot_keys,
    first_match,
    fits_broadcast,
    initial_load,
    insert_only,
    largest_key,
    overlay_chain,
    refresh,
    registry_base,
    role_keys,
    scd2_merge,
    settle_all,
    spread,
    upsert_replace,
)
from ..operators.skew import SALT
from ..functions.scalars import void_flag
from ..sources import (
    Lease,
    append,
    cut_lineage,
    lease,
    partition_columns,
    recover,
    replace,
    replace_open,
    require_table,
    rewrite_rows,
)
from . import feeds
from .layout import ADDRESS_LAYOUT, ADDRESS_ROLES, CONTACT_ALSO_ERASED, Tables

OrderBy = Sequence[str | Column]
BatchTs = str | datetime

CUSTOMER = ["CUSTOMER_ID"]
CUSTOMER_KEY = "CUSTOMER_KEY"
ADDRESS_KEY = "CUSTOMER_ADDRESS_KEY"
# Which staged row is used when an extract has several of one customer.
ORGANISATION_ORDER = ["SOURCE_CREATE_DT", "PRIMARY_PHONE_NUMBER", "DIGITAL_CUSTOMER_ID", "MARKET_PLACE_CUST_ID"]
CONTACT_TIMES = ["CUSTOMER_SINCE_DT", "CLIC_EMAIL_LAST_UPDT"]
CONTACT_ORDER = [*CONTACT_TIMES, "CLIC_EMAIL_ADDRESS", "LAST_NAME", "FIRST_NAME"]
ADDRESS_ORDER = list(ADDRESS_LAYOUT.content)


def contact_order() -> OrderBy:
    """The contact extract's dates are text: by time where they are one, then by text."""
    return [*[F.col(c).try_cast("timestamp") for c in CONTACT_TIMES], *CONTACT_ORDER]


#: Seconds to wait for the registry while another load reads or raises it.
REGISTRY_WAIT = 300.0

Hot = HotKeys | Callable[[], HotKeys] | None


def _needed(hot: Hot, steps: Sequence[Feed]) -> HotKeys | None:
    """Hot keys of a target, looked for only if some feed has to be joined by a shuffle."""
    if not callable(hot):
        return hot
    return None if all(s.small for s in steps) else hot()


# Frame to frame


def customers_to_insert(
    staged: DataFrame, target: DataFrame, base: int, batch_ts: BatchTs, on_duplicate: str = "keep"
) -> DataFrame:
    """New customers with their keys. NULL is a customer id like any other.

    ``on_duplicate``: ``keep`` loads every staged row of a new customer, ``latest`` (or
    ``first``) only one.
    """
    if on_duplicate not in ("keep", "latest", "first"):
        raise ValueError("on_duplicate is 'keep', 'latest' or 'first'")
    rows = feeds.new_customers(staged, batch_ts)
    few = fits_broadcast(rows.select(*CUSTOMER))
    hot = None if few else find_hot_keys(rows, CUSTOMER)
    new = insert_only(rows, target, CUSTOMER, unique=True, null_safe=True, small=few, hot=hot, prefilter=True)
    if on_duplicate != "keep":
        new = first_match(new, CUSTOMER, ORGANISATION_ORDER, latest=on_duplicate == "latest")
    return assign_surrogate_keys(new, base, CUSTOMER_KEY, CUSTOMER + ORGANISATION_ORDER)


def customers_to_upsert(
    staged: DataFrame, base: int, batch_ts: BatchTs, target: DataFrame | None = None
) -> DataFrame:
    """Staged customers with new keys, to replace stored ones whole; with a ``target``, only
    those it does not hold already with the same content (keys and batch numbers aside)."""
    rows = feeds.new_customers(staged, batch_ts)
    if target is not None:
        rows = changed_rows(rows, target, CUSTOMER, ignore=[CUSTOMER_KEY, feeds.UPDATED, feeds.INSERTED])
    return assign_surrogate_keys(rows, base, CUSTOMER_KEY, CUSTOMER + ORGANISATION_ORDER)


def contact_refreshed(
    target: DataFrame,
    staged: DataFrame,
    batch_ts: BatchTs,
    *,
    on_missing: str = "keep",
    stamp_all: bool = False,
    hot: Hot = None,
    settled: bool = False,
) -> DataFrame:
    """Customers with the contact extract's columns.

    ``on_missing="null"`` erases contact columns of customers the extract lacks.
    ``stamp_all`` gives every customer the batch number, also untouched ones.
    """
    rows = feeds.contact_feed(staged, None if on_missing == "null" or stamp_all else batch_ts)
    (feed,) = _settle([Feed(rows, contact_order(), latest=True)], settled)
    out = refresh(
        target, feed.rows, CUSTOMER, feed.order_by, latest=feed.latest,
        unique=feed.unique, on_missing=on_missing, also_erase=CONTACT_ALSO_ERASED, hot=_needed(hot, [feed]),
    )
    return feeds.stamp(out, batch_ts) if stamp_all else out


def organisation_refreshed(
    target: DataFrame,
    staged: DataFrame,
    batch_ts: BatchTs,
    *,
    on_missing: str = "keep",
    hot: Hot = None,
    settled: bool = False,
) -> DataFrame:
    """Customers with the organisation extract's columns; ``on_missing`` as above."""
    rows = feeds.organisation_feed(staged, batch_ts)
    (feed,) = _settle([Feed(rows, ORGANISATION_ORDER, latest=True)], settled)
    return refresh(
        target, feed.rows, CUSTOMER, feed.order_by, latest=feed.latest,
        unique=feed.unique, on_missing=on_missing, hot=_needed(hot, [feed]),
    )


def purge_and_merge_feeds(
    history: DataFrame, batch_ts: BatchTs | None = None, merge_source: str = "deleted"
) -> list[Feed]:
    """The two overlays that mark purged and merged customers."""
    purged = feeds.purge_feed(history)
    merged = feeds.merge_feed(history, merge_source)
    if batch_ts is not None:
        purged, merged = feeds.stamp(purged, batch_ts), feeds.stamp(merged, batch_ts)
    order = ["MERGED_DT", "MERGED_SOURCE_ACCT_ID"]
    return [Feed(purged, ["PURGED_DT"], latest=True), Feed(merged, order, latest=True)]


def history_marked(
    target: DataFrame,
    history: DataFrame,
    *,
    batch_ts: BatchTs | None = None,
    merge_source: str = "deleted",
    hot: Hot = None,
    settled: bool = False,
) -> DataFrame:
    """Customers with their purge and merge events."""
    steps = _settle(purge_and_merge_feeds(history, batch_ts, merge_source), settled)
    return overlay_chain(target, steps, CUSTOMER, hot=_needed(hot, steps))


def _settle(steps: Sequence[Feed], settled: bool) -> list[Feed]:
    return settle_all(steps, CUSTOMER) if settled else list(steps)


def address_keys_set(
    target: DataFrame,
    addresses: DataFrame,
    batch_ts: BatchTs,
    *,
    current_only: bool = True,
    within: str | None = None,
    hot: Hot = None,
) -> DataFrame:
    """Customers with the keys of their shipping, billing and marketing address."""
    if current_only:
        addresses = addresses.where(F.col(ADDRESS_LAYOUT.current) == 1)
    return role_keys(
        target, addresses, CUSTOMER_KEY, ADDRESS_KEY, "ADDR_NAME", ADDRESS_ROLES,
        stamp={feeds.UPDATED: feeds.batch(batch_ts)}, within=within, hot=hot,
    )


def refreshed_customers(
    target: DataFrame,
    organisation: DataFrame,
    contact: DataFrame,
    history: DataFrame,
    addresses: DataFrame,
    batch_ts: BatchTs,
    *,
    merge_source: str = "deleted",
    current_only: bool = True,
    key_only: bool = False,
    hot: Hot = None,
    settled: bool = False,
) -> DataFrame:
    """All feeds laid over the customers, one after the other.

    All overlays share one shuffle of the customers, by customer id. The three
    address roles are folded into one row per customer first; they are compared
    by customer key but brought together by customer id, which the key determines.
    ``key_only`` compares the customer key alone, for keys handed out to several
    customers; this shuffles the customers a second time. ``settled`` writes and
    measures every feed first, see ``settle_all``.
    """
    steps = [
        Feed(feeds.organisation_feed(organisation, batch_ts), ORGANISATION_ORDER, latest=True),
        Feed(feeds.contact_feed(contact, batch_ts), contact_order(), latest=True),
        *purge_and_merge_feeds(history, batch_ts, merge_source),
    ]
    steps = _settle(steps, settled)
    # The address roles are joined by the same key, so they count as one more step.
    hot = hot() if callable(hot) else hot
    customers = overlay_chain(spread(target, CUSTOMER, hot), steps, CUSTOMER, hot=hot)
    if key_only:
        return address_keys_set(customers.drop(SALT), addresses, batch_ts, current_only=current_only)
    return address_keys_set(
        customers, addresses, batch_ts, current_only=current_only, within=CUSTOMER[0], hot=hot
    ).drop(SALT)


# Table to table


@contextmanager
def _writing(spark: SparkSession, target: str) -> Iterator[Lease]:
    """Hold the target's lease, finish what a load that died left half done, insist on the table."""
    with lease(spark, target) as held:
        recover(spark, target)
        require_table(spark, target)
        yield held


def _base(spark: SparkSession, tables: Tables, name: str) -> int:
    """The last key handed out, from a registry that no load is writing."""
    with lease(spark, tables.registry, wait=REGISTRY_WAIT):
        recover(spark, tables.registry)
        require_table(spark, tables.registry)
        spark.catalog.refreshTable(tables.registry)
        return registry_base(spark.table(tables.registry), name)


def insert_customers(
    spark: SparkSession, batch_ts: BatchTs, tables: Tables = Tables(), on_duplicate: str = "keep"
) -> None:
    with _writing(spark, tables.customer_dim) as held:
        base = _base(spark, tables, tables.customer_registry_name)
        rows = customers_to_insert(
            spark.table(tables.organisation), spark.table(tables.customer_dim), base, batch_ts, on_duplicate
        )
        _take_keys(spark, tables, tables.customer_registry_name, rows, CUSTOMER_KEY, base, held)
        append(rows, tables.customer_dim)


def upsert_customers(
    spark: SparkSession, batch_ts: BatchTs, tables: Tables = Tables(), unchanged: str = "keep"
) -> None:
    """Replace stored customers by staged ones, whole, with new keys.

    ``unchanged="keep"`` leaves a customer alone whose stored rows hold just what is staged, so the same
    extract again changes nothing; ``"replace"`` replaces these too.
    """
    if unchanged not in ("keep", "replace"):
        raise ValueError("unchanged is 'keep' or 'replace'")
    with _writing(spark, tables.customer_dim) as held:
        base = _base(spark, tables, tables.customer_registry_name)
        target = spark.table(tables.customer_dim)
        staged = spark.table(tables.organisation)
        rows = customers_to_upsert(staged, base, batch_ts, target if unchanged == "keep" else None)
        _take_keys(spark, tables, tables.customer_registry_name, rows, CUSTOMER_KEY, base, held)
        few = fits_broadcast(rows.select(*CUSTOMER))
        hot = None if few else find_hot_keys(target, CUSTOMER)
        merged = upsert_replace(target, rows, CUSTOMER, small=few, hot=hot, null_safe=True)
        replace(merged, tables.customer_dim)


def refresh_from_contact(
    spark: SparkSession,
    batch_ts: BatchTs,
    tables: Tables = Tables(),
    *,
    on_missing: str = "keep",
    stamp_all: bool = False,
) -> None:
    with _writing(spark, tables.customer_dim):
        target = spark.table(tables.customer_dim)
        rows = contact_refreshed(
            target, spark.table(tables.contact), batch_ts, on_missing=on_missing, stamp_all=stamp_all,
            hot=lambda: find_hot_keys(target, CUSTOMER),
            settled=True,
        )
        replace(rows, tables.customer_dim)


def refresh_from_organisation(
    spark: SparkSession, batch_ts: BatchTs, tables: Tables = Tables(), *, on_missing: str = "keep"
) -> None:
    with _writing(spark, tables.customer_dim):
        target = spark.table(tables.customer_dim)
        rows = organisation_refreshed(
            target, spark.table(tables.organisation), batch_ts, on_missing=on_missing,
            hot=lambda: find_hot_keys(target, CUSTOMER),
            settled=True,
        )
        replace(rows, tables.customer_dim)


def mark_history(
    spark: SparkSession,
    tables: Tables = Tables(),
    *,
    batch_ts: BatchTs | None = None,
    merge_source: str = "deleted",
) -> None:
    with _writing(spark, tables.customer_dim):
        target = spark.table(tables.customer_dim)
        rows = history_marked(
            target, spark.table(tables.history), batch_ts=batch_ts, merge_source=merge_source,
            hot=lambda: find_hot_keys(target, CUSTOMER),
            settled=True,
        )
        replace(rows, tables.customer_dim)


def refresh_customers(
    spark: SparkSession,
    batch_ts: BatchTs,
    tables: Tables = Tables(),
    *,
    merge_source: str = "deleted",
    current_only: bool = True,
    key_only: bool = False,
) -> None:
    with _writing(spark, tables.customer_dim):
        target = spark.table(tables.customer_dim)
        rows = refreshed_customers(
            target,
            spark.table(tables.organisation),
            spark.table(tables.contact),
            spark.table(tables.history),
            spark.table(tables.address_dim),
            batch_ts,
            merge_source=merge_source,
            current_only=current_only,
            key_only=key_only,
            hot=lambda: find_hot_keys(target, CUSTOMER),
            settled=True,
        )
        replace(rows, tables.customer_dim)


def set_address_keys(
    spark: SparkSession, batch_ts: BatchTs, tables: Tables = Tables(), *, current_only: bool = True
) -> None:
    with _writing(spark, tables.customer_dim):
        target = spark.table(tables.customer_dim)
        rows = address_keys_set(
            target, spark.table(tables.address_dim), batch_ts, current_only=current_only,
            hot=lambda: find_hot_keys(target, [CUSTOMER_KEY]),
        )
        replace(rows, tables.customer_dim)


def insert_addresses(
    spark: SparkSession,
    batch_ts: BatchTs,
    tables: Tables = Tables(),
    *,
    created: str = "timestamp",
    on_duplicate: str = "latest",
) -> DataFrame:
    """Append first versions of new addresses; returns the rejected rows with reasons.

    ``on_duplicate``: ``latest`` (or ``first``) of several staged rows of a new address, or
    ``keep`` for all of them.
    """
    if on_duplicate not in ("keep", "latest", "first"):
        raise ValueError("on_duplicate is 'keep', 'latest' or 'first'")
    with _writing(spark, tables.address_dim) as held:
        base = _base(spark, tables, tables.address_registry_name)
        staged = feeds.address_feed(spark.table(tables.address), created).withColumn("PRIVACY_IND", F.lit(0))
        loaded = initial_load(
            staged,
            spark.table(tables.address_dim),
            spark.table(tables.customer_dim),
            base,
            batch_ts,
            ADDRESS_LAYOUT,
            None if on_duplicate == "keep" else ADDRESS_ORDER,
            latest=on_duplicate == "latest",
            # A customer may have any number of addresses.
            hot_parents=find_hot_keys(staged, CUSTOMER),
        )
        rejected = cut_lineage(loaded.rejected)
        _take_keys(spark, tables, tables.address_registry_name, loaded.rows, ADDRESS_KEY, base, held)
        append(loaded.rows, tables.address_dim)
        return rejected


def update_addresses(
    spark: SparkSession,
    batch_ts: BatchTs,
    tables: Tables = Tables(),
    *,
    compat: str = "corrected",
    created: str = "compact",
    effective: str | None = None,
) -> DataFrame:
    """Merge the address extract into the address versions.

    Returns the rejected rows with reasons. ``compat`` and ``effective`` as in
    ``scd2_merge``. A table partitioned by its current flag keeps the files of its
    history: only current rows are written again, those now closed are added, and files
    with wrong void flags are rewritten.
    """
    with _writing(spark, tables.address_dim) as held:
        base = _base(spark, tables, tables.address_registry_name)
        target = spark.table(tables.address_dim)
        staged = feeds.address_feed(spark.table(tables.address), created, effective)
        keys = list(ADDRESS_LAYOUT.natural_key)
        merged = scd2_merge(
            target,
            staged,
            spark.table(tables.customer_dim),
            base,
            batch_ts,
            ADDRESS_LAYOUT,
            ADDRESS_ORDER,
            latest=True,
            compat=compat,
            effective=effective,
            hot=find_hot_keys(target, keys) if compat != "corrected" else None,
            hot_parents=find_hot_keys(staged, CUSTOMER),
        )
        rejected = cut_lineage(merged.rejected)
        _take_keys(spark, tables, tables.address_registry_name, merged.added, ADDRESS_KEY, base, held)
        flag = ADDRESS_LAYOUT.current
        if compat == "corrected" and partition_columns(spark, tables.address_dim) == [flag]:
            current = expire(
                target.where(F.col(flag) == 1), merged.closing, ADDRESS_LAYOUT, batch_ts,
                effective=effective, small=fits_broadcast(merged.closing),
            )
            # Written once: the rows replace the partition they are read from.
            current = cut_lineage(current.unionByName(merged.added))
            open_rows, closed = current.where(F.col(flag) == 1), current.where(F.col(flag) == 0)
            void = void_flag(ADDRESS_LAYOUT.begin, ADDRESS_LAYOUT.end).cast(target.schema[ADDRESS_LAYOUT.void].dataType)
            wrong = ~F.col(ADDRESS_LAYOUT.void).eqNullSafe(void)
            rewrite_rows(spark, tables.address_dim, flag, 0, wrong, {ADDRESS_LAYOUT.void: void})
            replace_open(open_rows, closed, tables.address_dim, flag, ADDRESS_KEY)
        else:
            replace(merged.table, tables.address_dim)
        return rejected


class RegistryMoved(Exception):
    pass


def _take_keys(spark, tables: Tables, name: str, rows: DataFrame, key: str, base: int, held: Lease) -> None:
    """Raise the registry before the rows are written.

    A load that stops in between leaves a gap in the keys; the other order could
    hand out a key twice. Comparing and raising are one step for all loads, by the
    registry's own lease. If keys were taken since ``base`` was read, or the target's
    lease was lost, the load fails here and writes nothing.
    """
    used = largest_key(rows, key, base)
    with lease(spark, tables.registry, wait=REGISTRY_WAIT) as alone:
        recover(spark, tables.registry)
        spark.catalog.refreshTable(tables.registry)
        now = registry_base(spark.table(tables.registry), name)
        if now != base:
            raise RegistryMoved(f"the registry of {name} went from {base} to {now} during the load; run it again")
        held.check()
        if used > base:
            alone.check()
            replace(advance_registry(spark.table(tables.registry), name, used), tables.registry)
