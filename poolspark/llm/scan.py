"""Running values along the rows of each key, without gathering a key in one task.

Rows are dealt by ranges of key *and* order, so a long key spans several tasks.
Each task scans its sorted rows once; only the last row of each range goes to
the driver, as many as there are ranges, and comes back as what lies before the
first key of a range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.plans.shared import materialize


def _scan(key: str, xors: list[str], sums: list[str], seen):
    part, held, carry = TaskContext.get().partitionId(), None, {}
    for batch in seen:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(key).to_numpy()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
        out = {}
        for name, values in (("__n", np.ones(n, np.int64)), *((c, batch.column(c).to_numpy()) for c in (*xors, *sums))):
            f = np.bitwise_xor if name in xors else np.add
            run = f.accumulate(values)
            before = np.r_[np.int64(0), run[first[1:] - 1]][of]
            run = run ^ before if name in xors else run - before
            if keys[0] == held:  # the batch before ended within this key
                run[of == 0] = f(run[of == 0], carry[name])
            out[name] = run
        held, carry = keys[-1], {c: x[-1] for c, x in out.items()}
        rest = {c: batch.column(c) for c in batch.schema.names if c not in out}
        yield pa.record_batch(rest | {c: pa.array(x) for c, x in out.items()} | {"__part": pa.array(np.full(n, part, np.int64))})


def running(rows: DataFrame, key: str, order: list[str], n: str, xors: dict[str, str] | None = None, sums: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with ``n``, the place of each row among those of its ``key`` by ``order`` from 1, and running values up to it.

    ``key`` is a long without nulls.  ``xors`` and ``sums`` name new columns of
    longs: the exclusive or, or the sum, of the column that they stand for, which has
    no nulls.  Nulls of ``order`` come first.  The result is a written table.
    """
    xors, sums = xors or {}, sums or {}
    named = rows.withColumns({c: F.col(of).cast("long") for c, of in {**xors, **sums}.items()})
    dealt = named.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields if f.name not in {**xors, **sums})
    added = ["__n", *xors, *sums]
    schema += "".join(f", `{c}` long" for c in (*added, "__part"))
    held = materialize(dealt.mapInArrow(lambda seen: _scan(key, list(xors), list(sums), seen), schema), "scan")
    ends = held.groupBy("__part").agg(F.min(key).alias("lead"), F.max(F.struct(key, *added)).alias("last")).orderBy("__part").collect()  # one row for each range
    before, carry = [], None
    for r in ends:
        last = r["last"].asDict()
        if carry and carry[key] == r["lead"]:
            before.append((r["__part"], r["lead"], *(carry[c] for c in added)))
            if last[key] == r["lead"]:
                last |= {c: last[c] ^ carry[c] if c in xors else last[c] + carry[c] for c in added}
        carry = last
    if before:
        names = {c: f"__b{i}" for i, c in enumerate(added)}
        far = held.sparkSession.createDataFrame(before, ", ".join(f"{c} long" for c in ("__p", "__k", *names.values())))
        held = held.join(F.broadcast(far), (F.col("__part") == F.col("__p")) & (F.col(key) == F.col("__k")), "left")
        more = {c: F.coalesce(b, F.lit(0).cast("long")) for c, b in names.items()}
        held = held.withColumns({c: F.col(c).bitwiseXOR(more[c]) if c in xors else F.col(c) + more[c] for c in added})
    return held.select(*rows.columns, *xors, *sums, F.col("__n").alias(n))
