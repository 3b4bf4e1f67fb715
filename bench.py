"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs twice into a sink that discards its rows; the faster run counts.
``BENCH_QUERIES=all`` (or a comma list of names) times other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a2_bars_from_ticks", "a4_incremental_extract", "a10_lookback_extract", "b3_replace_day", "b11_scd2_snapshot",
    "c3_surrogate_key", "d3_position_close_left_join", "d6_asof_fill_join", "d8_overlap_anti_join", "e6_portfolio_metrics",
    "e7_weighted_scores", "f10_standardized_spread", "f12_rolling_entropy", "f13_roll_spread", "f15_ema", "f17_atr",
    "h1_triple_barrier", "h2_barrier_sweep", "h3_label_concurrency", "h6_purged_kfold", "h7_engle_granger_rolling", "h9_sadf",
    "h10_johansen_trace", "h11_hmm_decode", "h18_technical_features", "i4_ledger_replay", "j2_unique", "l1_fact_ohlc",
    "l2_fact_position", "l6_labelled_training_set",
]


def main() -> None:
    from pairloom.catalog import QUERIES
    from pairloom.session import builder

    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        builder("bench").master(f"local[{cpus}]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["l1_fact_ohlc"](spark, data).write.format("noop").mode("overwrite").save()  # warm the JVM
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(data.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
