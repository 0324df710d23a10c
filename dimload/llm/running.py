"""Running results along the rows of each key, where one key may hold most of the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.sources.scratch import cut_lineage


def running(
    rows: DataFrame,
    key: str,
    order: Sequence[Column],
    value: str,
    add: Callable[[int, Any], int],
    join: Callable[[int, int, int], int],
    put: Callable[[int], Any],
    kind: str,
    names: tuple[str, str, str],
) -> DataFrame:
    """``rows`` with, by ``names``, the place of a row among those of its key (from 1), the
    result of ``value`` over them before this row, and with it.

    Results are integers, 0 for no rows. ``add(result, value)`` adds a row; ``join(before, n, after)``
    joins the result of some rows with that of the ``n`` next. ``put`` makes a result a value of the column type ``kind``.

    Rows are dealt by ranges of ``key`` and ``order``, rows equal in both by the task that read
    them, and written to the checkpoint folder. A key may run over many tasks:
    each task works out what it adds to its last key, these results, one a task, are joined
    on the driver, and each task begins with what came before. Ties are in any order, the
    same from then on."""
    rows = rows.withColumn("__tie", F.spark_partition_id())
    rows = rows.repartitionByRange(F.col(key), *order, "__tie").sortWithinPartitions(F.col(key), *order).drop("__tie")
    rows = cut_lineage(rows)
    of, what = rows.columns.index(key), rows.columns.index(value)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, whole, at, n, result, kind_of_key = True, True, None, 0, 0, None
        for batch in batches:
            kind_of_key = batch.column(of).type
            for k, v in zip(batch.column(of).to_pylist(), batch.column(what).to_pylist()):
                if first or k != at:
                    whole, at, n, result, first = first, k, 0, 0, False
                n, result = n + 1, add(result, v)
        if not first:
            task = pa.array([TaskContext.get().partitionId()], pa.int32())
            columns = [task, pa.array([at], kind_of_key), pa.array([whole]), pa.array([n], pa.int64()), pa.array([str(result)])]
            yield pa.RecordBatch.from_arrays(columns, ["task", "at", "whole", "n", "result"])

    key_type = rows.schema[key].dataType.simpleString()
    ends = rows.mapInArrow(last, f"task int, at {key_type}, whole boolean, n long, result string").collect()
    starts, carried = {}, None
    for r in sorted(ends, key=lambda r: r["task"]):
        starts[r["task"]] = carried
        n, result = r["n"], int(r["result"])
        if carried and r["whole"] and carried[0] == r["at"]:
            result, n = join(carried[2], n, result), carried[1] + n
        carried = (r["at"], n, result)
    starts = rows.sparkSession.sparkContext.broadcast(starts)
    out_type = pa.binary() if kind == "binary" else pa.int64()

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, result = starts.value.get(TaskContext.get().partitionId()) or (None, 0, 0)
        for batch in batches:
            places, before, after = [], [], []
            for k, v in zip(batch.column(of).to_pylist(), batch.column(what).to_pylist()):
                if k != at:
                    at, n, result = k, 0, 0
                before.append(put(result))
                n, result = n + 1, add(result, v)
                places.append(n)
                after.append(put(result))
            more = [pa.array(places, pa.int64()), pa.array(before, out_type), pa.array(after, out_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(along, f"{schema}, {names[0]} long, {names[1]} {kind}, {names[2]} {kind}")


def running_sum(rows: DataFrame, key: str, order: Sequence[Column], value: str, names: tuple[str, str, str]) -> DataFrame:
    """Places, and sums of a long column before and with each row."""
    return running(rows, key, order, value, lambda a, v: a + v, lambda a, n, b: a + b, lambda a: a, "long", names)


#: A prime of 127 bits, and the factor of a step.
PRIME, STEP = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def running_digest(rows: DataFrame, key: str, order: Sequence[Column], value: str, names: tuple[str, str, str]) -> DataFrame:
    """Places, and digests (16 bytes) of the sequence of values (bytes) before and with each row.

    The digest of a sequence is a polynomial over its values, themselves digests: equal
    sequences have equal ones, others different ones but for a chance of about length / 2^127."""

    def add(a: int, v: bytes) -> int:
        return (a * STEP + int.from_bytes(v, "big") + 1) % PRIME

    def join(a: int, n: int, b: int) -> int:
        return (a * pow(STEP, n, PRIME) + b) % PRIME

    return running(rows, key, order, value, add, join, lambda a: a.to_bytes(16, "big"), "binary", names)
