"""Benchmark: headline jobs of the reference, timed at one scale factor.

usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each job runs to completion through the ``noop`` sink (every row is computed,
nothing is collected to the driver). Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

  csv_to_parquet     CSV parse + Parquet save (S01, S05)
  column_profile     profile of every column + top-5 values (A15, R05)
  transitions        transition statistics (W06-W08, A03-A08)
  label_split        target build + split (W10)
  fit                one GBT per label on the train rows (E06, E08)
  predict            predict + predict_proba on the test rows (E09, E10)
  metric_table       full metric table: accuracy, P / R / F1, ROC AUC (M02-M04)
  baselines          constant-mean and frequency baselines (M12, M13)
  stream_monitor     15-minute per-target counts as a stream (Q01)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.session import local_session, scratch_dir  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16),
                          app="panelkit-bench")

    from panelkit.operators import metrics as M
    from panelkit.operators import model as MD
    from panelkit.operators import panel as P
    from panelkit.operators import profile as A
    from panelkit.plans import catalog
    from panelkit.plans import q_model as QMD
    from panelkit.sources import io as IO
    from panelkit.sources import standins as S
    catalog.load_all()

    OP = S.ORDER_PRODUCTS
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    # Untimed set-up: the raw CSV the reference starts from, and the scored
    # tables its evaluation starts from (derived from the test tables).
    snap = S.snapshot(spark, sf_dir)
    csv_path = os.path.join(scratch_dir(spark, "bench-csv"), "snapshot")
    IO.write_csv(snap, csv_path)
    schema = snap.schema
    scored_dir = scratch_dir(spark, "bench-scored")
    S.scored_panel(spark, sf_dir).write.parquet(os.path.join(scored_dir, "panel"))
    S.scored(spark, sf_dir).write.parquet(os.path.join(scored_dir, "docs"))
    table = os.path.join(scratch_dir(spark, "bench-pq"), "snapshot")

    def csv_to_parquet():
        IO.csv_to_parquet(spark, csv_path, table, schema)

    timed("csv_to_parquet", csv_to_parquet)

    def panel():
        return spark.read.parquet(table)

    def column_profile():
        from pyspark import StorageLevel
        p = panel()
        counts = A.value_counts_long(p).persist(StorageLevel.MEMORY_AND_DISK)
        run(A.column_profile(p, counts=counts))
        run(A.top_values(p, k=5, counts=counts))
        counts.unpersist()

    timed("column_profile", column_profile)

    def transitions():
        s = panel()
        run(P.count_changes(s, OP))
        run(P.transition_table(s, OP))
        run(A.client_product_summary(s, OP))
        run(A.comparable_cells(s, OP))

    timed("transitions", transitions)

    def split():
        lab = P.build_labels(panel(), OP)
        train, test = P.split_by_date(lab, S.ORDER_SPLIT_DATE)
        return P.since(P.clean(train), S.ORDER_START_DATE), P.clean(test)

    def label_split():
        train, test = split()
        run(train)
        run(test)

    timed("label_split", label_split)

    holder = {}

    def fit():
        train, _ = split()
        holder["model"] = MD.fit_product_model(train, OP, QMD.TARGETS)

    timed("fit", fit)

    def predict():
        _, test = split()
        run(holder["model"].score(test))
        run(MD.recommend(holder["model"], test))

    timed("predict", predict)

    def metric_table():
        sp = spark.read.parquet(os.path.join(scored_dir, "panel"))
        run(M.metric_table(sp, ["id", "fetch_date"]))
        run(M.metric_table(spark.read.parquet(os.path.join(scored_dir, "docs")), ["row_id"]))

    timed("metric_table", metric_table)

    def baselines():
        run(catalog.QUERIES["m12_constant_mean_baseline"](spark, sf_dir))
        run(catalog.QUERIES["m13_frequency_baseline"](spark, sf_dir))

    timed("baselines", baselines)

    def stream_monitor():
        run(catalog.QUERIES["q01_target_counts_15min"](spark, sf_dir))

    timed("stream_monitor", stream_monitor)

    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
