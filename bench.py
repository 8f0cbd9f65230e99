"""Time the headline queries and print one JSON line.

Tables on a cluster consist of many files; the driver's are one row group each,
which a single task has to read. They are rewritten as one file per core first,
and that step is timed and counted. Every query then runs once untimed on the
same tables to load classes, and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from lendframe.session import get_session
from verification.queries import QUERIES

HEADLINE = (
    "rollup_installments rollup_bureau rollup_previous rollup_pos_cash rollup_credit_card assemble_matrix profile_columns"
    " validate_tables join_stats stratified_split factorize woe_table binning_fit auc_gini reliability cost_sweep feature_drift"
    " calibrate decide_batch reason_codes topk_contributions score_batch"
).split()

TABLES = ("customer", "orders", "lineitem", "events", "documents", "labels")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    start = time.perf_counter()
    work = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{work}/{table}.parquet")
    times["rewrite_tables"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, work).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
