"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores, ``BENCH_RUNS`` the timed runs
per query after one warm-up (median counts). ``BENCH_ALL=1`` times every query. Queries on
the stored table of bars build it in their timed runs; ``with_stored_bars`` has the seconds of
those queries once more, where the table is there already.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom import catalog, schemas  # noqa: E402
from barloom.operators import bars, indicators, project  # noqa: E402
from barloom.plans import views  # noqa: E402
from barloom.session import get_session, work_folder  # noqa: E402
from barloom.sources import readers, sinks  # noqa: E402

HEADLINE = (
    "bars_week",
    "bars_month",
    "bars_multi_grain",
    "ind_all",
    "signal_macd_cross",
    "forward_return",
    "flow_ratio",
    "flow_positive_days",
    "flow_streak",
    "screen_stocks",
    "join_latest_version",
    "join_asof_prev_trade",
    "join_range_holiday",
    "revenue_mom_yoy_ytd",
    "reshape_transpose_money",
    "scd_changed_securities",
    "statement_unify",
    "quote_snapshot",
    "src_json_quotes",
    "text_term_freq",
    "text_term_assoc",
    "stream_bars_tumbling",
)

ON_STORED_BARS = ("ind_all", "signal_macd_cross", "forward_return", "screen_stocks", "join_asof_prev_trade")


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    whole = catalog.load().queries
    names = list(whole) if os.environ.get("BENCH_ALL") else HEADLINE
    tasks = {name: lambda name=name: run(whole[name](spark, folder)) for name in names}

    # the same operators on a stored table of daily bars, as they run in production
    stored = work_folder(spark, "stock_price")
    sinks.append(project.conform(views.bars(spark, folder), schemas.STOCK_PRICE), stored)

    def prices():
        return readers.read_prices(spark, stored).drop("data_year")

    tasks |= {
        "bars_daily_from_trades": lambda: run(views.bars(spark, folder)),
        "stored_bars_week": lambda: run(bars.bars_week(prices())),
        "stored_sma": lambda: run(indicators.sma(prices())),
        "stored_ema26": lambda: run(indicators.ema(prices(), 26)),
        "stored_stoch": lambda: run(indicators.stoch(prices())),
        "stored_macd": lambda: run(indicators.macd(prices())),
        "stored_all_indicators": lambda: run(indicators.indicators(prices())),
    }

    times, kept = {}, {}
    for name, task in tasks.items():
        task()
        took = []
        for _ in range(runs):
            views.forget_stored_bars()
            started = time.perf_counter()
            task()
            took.append(time.perf_counter() - started)
        times[name] = round(statistics.median(took), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        if name in ON_STORED_BARS:
            started = time.perf_counter()
            task()
            kept[name] = round(time.perf_counter() - started, 3)

    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "with_stored_bars": kept,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
