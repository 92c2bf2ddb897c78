"""Time the registered queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each query runs once to
warm up and then $BENCH_RUNS times (default 3); its time is the median, from building the query to
the last row. ``input_writing`` tells how long those inputs take that some queries write for
themselves first, and ``keyed_diff`` how long the diff of all order columns takes in one pass and
as one diff per column.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from featward import diff_cells, get_spark
from featward.plans.inputs import dated_files, dated_tree, ordered_csv, original_orders, table
from featward.plans.queries import QUERIES
from featward.session import clear_scratch


def order_versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raised = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders, orders.withColumn("o_totalprice", raised)


def one_pass(spark, sf_dir):
    drain(diff_cells(*order_versions(spark, sf_dir), key="o_orderkey"))


def one_diff_per_column(spark, sf_dir):
    original, new = order_versions(spark, sf_dir)
    key = "o_orderkey"
    for name in original.columns[1:]:
        drain(diff_cells(original.select(key, name), new.select(key, name), key=key))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run, times: int) -> float:
    run()
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "featward-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {
        name: seconds(lambda q=query: drain(q(spark, sf_dir)), runs) for name, query in QUERIES.items()
    }
    shapes = {
        run.__name__: seconds(lambda r=run: r(spark, sf_dir), runs)
        for run in (one_pass, one_diff_per_column)
    }
    inputs = {
        "dated_files": seconds(lambda: dated_files(spark, sf_dir), runs),
        "dated_tree": seconds(lambda: dated_tree(spark, sf_dir), runs),
        "ordered_csv": seconds(lambda: ordered_csv(original_orders(spark, sf_dir), "id"), runs),
    }
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "keyed_diff": shapes,
                "input_writing": inputs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
