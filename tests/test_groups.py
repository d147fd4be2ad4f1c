"""Read groups that arrive in several files."""

import os
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from poolspark import catalogue
from poolspark.operators import assign
from poolspark.streaming import groups

DIR = "/root/testdata/sf0.001"


def plain(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_groups_go_on_whole_and_once(spark, tmp_path):
    rows = catalogue.Views(spark, DIR).assignment.filtered.where("CAST(substr(BC, 3, 6) AS INT) < 60").select("Read", "BC", "Genome", "MAPQ", "as_", "NM", "XAcount", "frag_loc")
    rows = rows.unionByName(rows.where("Genome = 'G1'")).persist()  # repeated rows come in other files
    folder, place, n = str(tmp_path / "in"), str(tmp_path / "out"), 0

    def arrive(df, seconds):
        nonlocal n
        n += 1
        df.coalesce(1).write.parquet(f"{tmp_path}/part{n}")
        (name,) = [f for f in os.listdir(f"{tmp_path}/part{n}") if f.endswith(".parquet")]
        os.makedirs(folder, exist_ok=True)
        os.rename(f"{tmp_path}/part{n}/{name}", f"{folder}/{n:03}.parquet")
        os.utime(f"{folder}/{n:03}.parquet", (1_700_000_000 + seconds,) * 2)

    def run():
        return groups.run(spark, folder, rows.schema, 100, place=place, files=1)

    nobody = spark.createDataFrame([(None, None, "G1", 30, 1, 1, 0, "")], rows.schema)
    early = F.pmod(F.xxhash64("Read"), F.lit(2)) == 0
    arrive(rows.where(early & F.col("Genome").isin("G0", "G1")), 0)
    arrive(rows.where(early & ~F.col("Genome").isin("G0", "G1")), 50)
    assert run().collect() == []  # all groups are open
    arrive(rows.where(~early & (F.col("Genome") == "G0")), 200)
    assert plain(run()) == plain(assign.by_read(rows.where(early)))
    arrive(rows.where(~early & (F.col("Genome") != "G0")), 290)
    arrive(nobody, 500)
    want = plain(assign.by_read(rows))
    assert plain(run()) == want
    arrive(nobody, 900)
    assert plain(run()) == want  # nothing is given twice
    rows.unpersist()


class Handle:
    """A state of one key in memory, which counts what is asked of it."""

    def __init__(self):
        self.calls, self.timers, self.held, self.value = 0, [], [], None

    def _count(self, f):
        def run(*args):
            self.calls += 1
            return f(*args)

        return run

    def getListState(self, name, schema):
        return SimpleNamespace(appendList=self._count(self.held.extend), get=self._count(lambda: iter(self.held)), put=self._count(self._replace), clear=self._count(self.held.clear))

    def getValueState(self, name, schema):
        own = lambda v: setattr(self, "value", v)
        return SimpleNamespace(exists=self._count(lambda: self.value is not None), get=self._count(lambda: self.value), update=self._count(own), clear=self._count(lambda: own(None)))

    def _replace(self, rows):
        self.held[:] = rows

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)


def test_state_is_asked_by_bucket_and_not_by_group():
    handle, own = Handle(), groups.OpenReads(100)
    own.init(handle)
    row = lambda i, g, ms: (f"r{i}", "B", g, 30, None, 1, 0, "", ms)
    part = lambda rows: pd.DataFrame(rows, columns=groups.HELD.names)
    expire = lambda ms, mark: [d for d in own.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), SimpleNamespace(getExpiryTimeInMs=lambda: ms))]
    list(own.handleInputRows((7,), iter([part([row(i, "G0", i % 2) for i in range(2000)]), part([("r", None, "G0", 1, 1, 1, 0, "", 0)])]), None))
    list(own.handleInputRows((7,), iter([part([row(i, "G1", 50) for i in range(0, 2000, 4)])]), None))
    assert handle.timers == [100] and handle.calls < 10
    (first,) = expire(100, 100)  # groups of even number whose last row is at 0
    assert len(first) == first["Read"].nunique() == 500 and set(first["Genome"]) == {"G0"} and first["as_"].isna().all()
    assert handle.timers == [100, 101] and expire(100, 101) == []
    (second,) = expire(101, 140)
    assert len(second) == 1000 and handle.timers[-1] == 150
    (last,) = expire(150, 150)
    assert last.groupby("Read").size().eq(2).all() and last["Read"].nunique() == 500
    assert handle.held == [] and handle.value is None and handle.calls < 40
