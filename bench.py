"""Headline queries at one scale: prints one JSON line.

Setup stores what a running installation stores: readings partitioned by date, the region of every
location, named points and the text index. ``loaded_*`` queries run on those tables, the others on the
given files with nothing prepared. Each query runs once to warm up, then ``BENCH_RUNS`` times; the best
run counts. Results go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from skyloom.operators import fulltext, spatial, vectors, weather  # noqa: E402
from skyloom.plans import inputs  # noqa: E402
from skyloom.plans.queries import QUERIES, T_FROM, T_TO, _probes  # noqa: E402
from skyloom.session import local_session, new_work_path  # noqa: E402
from skyloom.sources.tables import write_readings  # noqa: E402

RAW = [
    "region_snapshot_all", "proximity_batch", "minavgmax_wind_speed_all", "snapshot_wind", "hourly_agg",
    "rank_places", "build_postings", "match_batch", "knn_batch_blocks", "percentile_summary",
    "log_histogram",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "2"))

    base = new_work_path(spark, "bench")
    setup, start = {}, time.perf_counter()

    def done(step: str) -> None:
        nonlocal start
        setup[step] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()

    write_readings(inputs.readings(spark, sf), f"{base}/readings", files_per_day=1)
    readings = spark.read.parquet(f"{base}/readings")
    done("partition")
    spatial.locate_regions(readings, inputs.edges(spark)).write.parquet(f"{base}/located")
    inputs.geo_points(spark, sf).write.parquet(f"{base}/points")
    done("locate")
    fulltext.build_postings(
        inputs.region_texts(spark, sf), "region_id", list(fulltext.TEXT_COLUMNS)
    ).write(f"{base}/index")
    done("index")
    located, points = spark.read.parquet(f"{base}/located"), spark.read.parquet(f"{base}/points")
    index = fulltext.TextIndex.read(spark, f"{base}/index")

    vecs, probes = inputs.table(spark, sf, "embeddings"), _probes(spark, sf)
    as_queries = vecs.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    day = "measurement_date"
    loaded = {
        "loaded_region_snapshot": lambda: weather.region_snapshot(readings, None, points, "Concave", located, day),
        "loaded_region_snapshot_all": lambda: weather.region_snapshot_all(readings, None, points, located, day),
        "loaded_proximity_minmax": lambda: spatial.proximity_minmax(
            readings, 7.75, 49.25, "2024-01-10", partition_col=day
        ),
        "loaded_proximity_batch": lambda: spatial.proximity_batch(readings, probes, 1.0, partition_col=day),
        "loaded_minavgmax_all": lambda: weather.minavgmax_for_region(
            readings, None, "temperature", "ALL", T_FROM, T_TO, located, day
        ),
        "loaded_snapshot_wind": lambda: weather.metric_snapshot(
            readings, None, points, "wind", "ALL", T_FROM, T_TO, located, day
        ),
        "loaded_extreme_place": lambda: weather.extreme_place(
            readings, None, points, "temperature", "coldest", T_FROM, T_TO, located, day
        ),
        "loaded_hourly_agg": lambda: weather.hourly_agg(readings, time_col="reading_ts"),
        "loaded_fts_topk": lambda: fulltext.fts_topk(fulltext.match_bm25(index, "economics", "thon"), 3),
        "loaded_fts_multi": lambda: fulltext.fts_topk(
            fulltext.match_bm25_multi(index, list(fulltext.TEXT_COLUMNS), "tion ther"), 5
        ),
        "loaded_match_batch": lambda: fulltext.match_batch(index, "economics", inputs.text_queries(spark), 3),
        "loaded_knn_batch": lambda: vectors.knn_batch(vecs, "vec_id", "embedding", as_queries, 5),
    }

    times = {name: timed(lambda q=query: run(q()), runs) for name, query in loaded.items()}
    times |= {name: timed(lambda q=QUERIES[name]: run(q(spark, sf)), runs) for name in RAW}

    n_probes, n_vectors = probes.count(), vecs.count()
    rates = {
        "probes_per_sec": round(n_probes / times["loaded_proximity_batch"]),
        "regions_per_sec": round(len(inputs.REGION_RINGS) / times["loaded_region_snapshot_all"], 2),
        "vector_queries_per_sec": round(n_vectors / times["loaded_knn_batch"]),
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "setup_sec": round(sum(setup.values()), 3),
                "setup_steps": setup,
                **rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
