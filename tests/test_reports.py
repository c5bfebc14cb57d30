"""Exports read back: nested JSON reports and sorted CSV files."""

import glob
import os
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hourglass.sources import files


def test_json_report_keeps_its_nesting(spark, tmp_path):
    report = spark.createDataFrame([("m1", 1.5, 2.5, None), ("m2", 0.5, 0.75, 3.0)], "model string, mae double, rmse double, lo double")
    nested = report.select("model", F.struct(F.struct("mae", "rmse").alias("errors"), "lo").alias("test"))
    path = str(tmp_path / "report")
    files.write_json_report(nested, path)
    back = spark.read.schema(nested.schema).json(path)
    assert sorted(back.collect()) == sorted(nested.collect())


def test_sorted_csv_is_ordered_across_files(spark, tmp_path):
    df = spark.range(1000).select(((F.col("id") * 37) % 101).alias("ts"), (F.col("id") % 7).alias("series")).repartition(5)
    path = str(tmp_path / "sorted")
    files.write_csv(df, path, sort_by=("ts", "series"))
    got = []
    for part in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(part) as f:
            got += [tuple(map(int, line.split(","))) for line in f.read().splitlines()[1:]]
    assert got == sorted((r.ts, r.series) for r in df.collect())


def test_every_event_type_is_correlated(spark, tmp_path):
    from hourglass.plans import q_series

    rng = np.random.default_rng(3)
    types = ["click", "error", "refund", "view", "zoom"]  # two outside the five of the driver tables, two of those absent
    rows = [(i, f"2024-02-{1 + i // 5 // 24:02d} {i // 5 % 24:02d}:30:00", types[i % 5], float(rng.normal())) for i in range(5 * 96)]
    rows.append((999, "2024-03-05 00:30:00", "late", 1.0))  # shares no hour with the others
    ev = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double")
    ev.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    wide = pd.DataFrame(rows, columns=["id", "ts", "t", "v"]).pivot(index="ts", columns="t", values="v")
    got = {(r.col_a, r.col_b): r.r for r in q_series.event_corr_matrix(spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(combinations(sorted([*types, "late"]), 2))
    for (a, b), r in got.items():
        assert r is None if "late" in (a, b) else abs(r - wide[a].corr(wide[b])) < 1e-6
    best = sorted(((abs(r), a, b) for (a, b), r in got.items() if r is not None), reverse=True)[:5]
    top = q_series.summary_report(spark, str(tmp_path)).where("section = 'top_correlations'").orderBy("rank").collect()
    assert [r.label for r in top] == [f"{a} vs {b}" for _, a, b in best]
