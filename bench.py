"""Time the headline work; prints one JSON line.

Landed pages are derived from the tables first (not timed). Timed are: pages to staging,
the six table jobs from staging to written tables (one by one, then together), filters and numbering on the staging
table, and registered queries straight from the flat tables. Every figure is the median of
three runs after one warm-up.

    BENCH_SF_DIR   default /root/testdata/sf0.1
    BENCH_CPUS     default 8
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from marquee.adapters.order_tables import landed_pages  # noqa: E402
from marquee.operators import filters, ranking  # noqa: E402
from marquee.operators.filters import TitleFilter  # noqa: E402
from marquee.plans.checks import COUNTRIES, GENRES, QUERIES, SERVICES  # noqa: E402
from marquee.plans.publish import run_jobs  # noqa: E402
from marquee.plans.stage import stage_pages  # noqa: E402
from marquee.schemas import TITLE_TABLES  # noqa: E402
from marquee.session import build_session, scratch_scope  # noqa: E402
from marquee.sources import read_staging  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def main() -> None:
    work = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__checkpoint__dir=f"{work}/checkpoints",
    )
    spark.sparkContext.setLogLevel("ERROR")
    landed, staged, root = f"{work}/pages", f"{work}/staging", f"{work}/tables"
    pages = landed_pages(spark, SF_DIR)
    pages.repartition(int(CPUS)).write.partitionBy("min", "max").json(landed)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def drained(query):
        def work() -> None:
            with scratch_scope(spark):
                drain(query(spark, SF_DIR))

        return work

    def filtered(**wanted):
        return lambda: drain(
            filters.filter_titles(read_staging(spark, staged), TitleFilter(**wanted)).select(
                "id", "content_title"
            )
        )

    work_items = {"pages_to_staging": lambda: stage_pages(spark, landed, staged, multi_line=False, refresh=True)}
    for contract in TITLE_TABLES:
        work_items[contract.name] = lambda name=contract.name: run_jobs(
            spark, staged, root, only=(name,)
        )
    work_items |= {
        "all_tables": lambda: run_jobs(spark, staged, root),
        "filter_years": filtered(years=(1996, 1998)),
        "filter_services": filtered(services=SERVICES),
        "filter_genres": filtered(genres=GENRES, exclude_countries=COUNTRIES),
        "filter_offers": lambda: drain(filters.filter_offers(read_staging(spark, staged), SERVICES)),
        "first_page": lambda: drain(ranking.first_page(read_staging(spark, staged))),
        "number_pages": lambda: drain(ranking.number_pages(read_staging(spark, staged))),
    }
    for name in ("dim_titles_streaming_services", "titles_on_service_table", "page_completeness"):
        work_items[f"from_tables_{name}"] = drained(QUERIES[name])

    seconds = {}
    for name, action in work_items.items():
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            action()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline work, median of 3 warm runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
