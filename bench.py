"""Time the stored layers and the headline queries on the tables in $BENCH_SF_DIR and print one JSON line.

Layers are built first, each on its own line; ``queries`` has the first run of each query over them, ``warm`` the second.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans.queries import CATALOG, tables_for  # noqa: E402
from tidemark.session import configure  # noqa: E402

LAYERS = [
    "stored_shipments",
    "tracking",
    "cases",
    "stored_orders",
    "stored_enriched",
    "reconciliation",
    "logistics_controls",
    "controls",
    "candidates",
    "incidents",
    "carrier_facts",
    "registry",
]
HEADLINE = [
    "app_funnel_daily",
    "orders_enriched",
    "shipments_enriched",
    "commerce_performance",
    "logistics_daily",
    "executive_daily",
    "daily_reconciliation",
    "source_assertions",
    "dq_controls",
    "hub_windows",
    "hub_incidents",
    "rca_verdict",
    "logistics_performance",
    "customer_experience",
    "incident_command_center",
    "report_validation",
]


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    stored = tempfile.mkdtemp(prefix="tidemark-bench-")  # one machine: executors share it
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.minPartitionNum", cpus)
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.checkpoint.dir", stored)
        .config("spark.sql.warehouse.dir", f"{stored}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    tables = tables_for(spark, folder)
    layers = {name: timed(lambda n=name: getattr(tables, n)) for name in LAYERS}

    def run(name: str) -> float:
        return timed(lambda: CATALOG[name](tables).write.format("noop").mode("overwrite").save())

    cold = {name: run(name) for name in names}
    warm = {name: run(name) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(layers.values()) + sum(cold.values()), 3),
        "unit": "sec",
        "queries": cold,
        "warm": warm,
        "layers": layers,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    tables.release()
    spark.stop()


if __name__ == "__main__":
    main()
