"""What the text operators keep on disk and deal out: shuffle files, cells of the same members."""

from __future__ import annotations

import os
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import cells
from ledgerlake.llm.common import scratch


def _shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for top in manager.localDirs() for _, _, names in os.walk(top.getPath())
            for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_scratch_leaves_no_shuffle_files_and_no_settings(spark):
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    settings = [spark.conf.get(k, None) for k in keys]
    before = _shuffle_files(spark)
    sizes = scratch(spark, spark.range(1000).repartition(4, "id").mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long"), "t", 100)
    end = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < end:         # removed in the background
        time.sleep(0.1)
    assert not left
    assert sizes.agg(F.sum("n"), F.max("n")).first() == (1000, 100)
    assert [spark.conf.get(k, None) for k in keys] == settings


def test_members_that_meet_in_many_lists_are_compared_once(spark, monkeypatch):
    rows = [(token, node, 4, part) for token in range(20) for node, part in ((1, 1), (2, 2), (3, 3))]
    sets = {1: [1, 2, 3, 4], 2: [1, 2, 3, 4], 3: [5, 6, 7, 8]}
    opened = scratch(spark, spark.createDataFrame(rows, "token long, node long, n long, part long"), "t-open")
    shingles = spark.createDataFrame([(k, bytearray(np.array(s, np.uint64).tobytes())) for k, s in sets.items()],
                                     "node long, shingles binary")
    counted = {}

    def counting(session, df, label, *more):
        out = scratch(session, df, label, *more)
        counted[label] = out.count()
        return out

    monkeypatch.setattr(cells, "scratch", counting)
    links = cells.links_between(spark, opened, ["token"], 75, 256, 2000, lambda name, rows: np.ones(rows.num_rows, bool),
                                lambda nodes: shingles.join(nodes, "node", "left_semi"), "t")
    assert [{r.u, r.v} for r in links.collect()] == [{1, 2}]
    assert counted["t-members"] == 3
