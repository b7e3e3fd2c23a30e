"""Time all queries of the warehouse and print one JSON line.

BENCH_SF_DIR names the directory of driver tables, BENCH_CPUS the local cores.
Every query is planned anew and its full result is produced (no rows are
skipped). The JVM is warmed up by one cleaning job and one build of the star
schema; ``gold_build`` is a second build, and the reports read that one.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession

from contract import model, registry

# Builds and loads whole layers from files; timed once each like the others.
HEADLINE = list(registry.QUERIES)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetlake bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    consume(registry.QUERIES["clean_employees"](spark, sf_dir))
    model.gold(spark, sf_dir)
    seconds = {"gold_build": timed(lambda: model.gold(spark, sf_dir, fresh=True))}
    for key in HEADLINE:
        seconds[key] = timed(lambda: consume(registry.QUERIES[key](spark, sf_dir)))
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
