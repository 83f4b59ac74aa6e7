"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3), BENCH_QUERIES (comma list, default the headline set).
Each query runs once in full, from the test tables ("cold": a report builds its silver
layer, section_lines writes its lines first; also the warm-up), then BENCH_REPEAT times on
inputs written beforehand ("queries": the median; "fixture_sec": writing those inputs).
A run = build the DataFrame and execute it fully into the no-op sink (no collect to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "channel_insights",
    "business_kpis",
    "keyword_market",
    "geographic_insights",
    "trending",
    "video_time_series",
    "search_facts",
    "section_lines",
    "flatten_search",
    "dedupe_first",
    "dense_ids",
    "latest_top_k",
]

# Reports that read a written silver layer.
REPORTS = ["channel_insights", "business_kpis", "keyword_market", "geographic_insights", "trending", "video_time_series"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from demandlens.session import get_session

    spark = get_session(
        f"local[{cpus}]",
        app_name="demandlens-bench",
        shuffle_partitions=max(8, cpus * 2),
        extra={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    from demandlens.plans import queries as Q

    def run(name: str, **given) -> float:
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir, **given).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Inputs that stand in storage in a deployment: the silver layer of the reports, export lines.
    t0 = time.perf_counter()
    layer = Q.SilverLayer(spark, sf_dir)
    given = {n: {"layer": layer} for n in REPORTS if n in names}
    if given:
        _ = [getattr(layer, t) for t in ("keywords", "census", "trends", "search", "stats", "top")]
    if "section_lines" in names:
        given["section_lines"] = {"lines": Q.stored_section_lines(spark, sf_dir)}
    fixture = round(time.perf_counter() - t0, 3)
    results, cold = {}, {}
    for name in names:
        cold[name] = round(run(name), 3)  # with its own layer or lines; also the warm-up
        results[name] = round(statistics.median(run(name, **given.get(name, {})) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "cold": cold,
        "fixture_sec": fixture,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
