"""Leases: of several loads that write one table, one goes on at a time."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import SparkSession

from . import files

#: Seconds after which a lease counts as left behind by a load that died.
STALE_AFTER = 12 * 3600.0


class LeaseHeld(Exception):
    """Another load holds the lease."""


class LeaseLost(Exception):
    """The lease was taken over, because it had become too old."""


@dataclass(frozen=True)
class Lease:
    spark: SparkSession
    path: str
    token: str

    def check(self) -> None:
        """Insist that the lease is still this one's."""
        if files.read_text(self.spark, self.path).split("\n")[0] != self.token:
            raise LeaseLost(f"{self.path} belongs to another load; nothing more may be written")


def _path(spark: SparkSession, table: str, purpose: str) -> str:
    database, _, name = table.rpartition(".")
    described = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").collect()
    place = next(r["info_value"] for r in described if r["info_name"] == "Location")
    return f"{place.rstrip('/')}/_leases/{quote(f'{name}.{purpose}')}"


@contextmanager
def lease(
    spark: SparkSession,
    table: str,
    purpose: str = "write",
    *,
    wait: float = 0.0,
    stale_after: float = STALE_AFTER,
) -> Iterator[Lease]:
    """Hold the lease of a table while the block runs.

    The lease is a small file in the folder of the table's database, created in one step
    that fails if there is one, and deleted at the end. If another load holds it, ``LeaseHeld``
    is raised, after ``wait`` seconds. A load that dies leaves its file; once that is
    older than ``stale_after`` seconds the next load moves it away, which only one can,
    and takes its own. A load that takes longer finds out by ``check`` before it writes.
    """
    path, token = _path(spark, table, purpose), uuid.uuid4().hex
    until = time.monotonic() + wait
    while not files.create_text(spark, path, f"{token}\n{spark.sparkContext.applicationId}"):
        old = files.age(spark, path)
        if old is not None and old > stale_after:
            grave = f"{path}.{token}"
            if files.move(spark, path, grave):
                files.delete(spark, grave)
            continue
        if time.monotonic() >= until:
            holder = files.read_text(spark, path).split("\n")[-1]
            raise LeaseHeld(f"{holder or 'another load'} has been writing {table} for {old or 0:.0f} s")
        time.sleep(0.2)
    held = Lease(spark, path, token)
    try:
        yield held
    finally:
        if files.read_text(spark, path).split("\n")[0] == token:
            files.delete(spark, path)
