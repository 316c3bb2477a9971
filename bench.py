"""Headline timings: prints one JSON line.

The raw text landings are written once, outside the clock, the way Bronze would hold them. Every job then runs from
those files to its full result (reports collected, tables written). $BENCH_SF_DIR and $BENCH_CPUS choose the data and the
cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tamiz.contract import Contract  # noqa: E402
from tamiz.operators import dedup  # noqa: E402
from tamiz.plans.profiling import LedgerColumns, ledger_sections, run_sections  # noqa: E402
from tamiz.plans.quality import ledger_quality, survey_quality  # noqa: E402
from tamiz.plans.schema_validation import validate_contract  # noqa: E402
from tamiz.plans.silver import ledger_silver, survey_silver  # noqa: E402
from tamiz.profile.columns import column_profile  # noqa: E402
from tamiz.session import scratch  # noqa: E402
from tamiz.sinks.tables import overwrite_flat, overwrite_partitions  # noqa: E402
from workload.quality import LEDGER_CONFIG, SCORECARD, SURVEY_CONFIG, scores  # noqa: E402
from workload.silver import LEDGER, RUN_AT, SURVEY, SURVEY_ORDERS  # noqa: E402
from workload.tables import AS_OF, raw_lines, raw_orders, table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    landing = scratch(spark, "bench")
    raw_lines(spark, SF_DIR).repartition(int(CPUS)).write.parquet(f"{landing}/lines")
    raw_orders(spark, SF_DIR).repartition(int(CPUS)).write.parquet(f"{landing}/orders")

    def lines() -> DataFrame:
        return spark.read.parquet(f"{landing}/lines")

    def orders() -> DataFrame:
        return spark.read.parquet(f"{landing}/orders")

    def lineitem() -> DataFrame:
        return table(spark, SF_DIR, "lineitem")

    parts = LedgerColumns(
        categorical=("flag", "line_status", "ship_month", "line_code"),
        business_key=("l_orderkey", "l_linenumber"),
        pairs=(("flag", "line_status"), ("supplier", "parent_code")),
        amounts=("price", "quantity", "discount"),
        time={"ship_year": (1995, 2001, False), "ship_month": (1, 12, True)},
        year="ship_year",
        month="ship_month",
        amount="price",
    )
    contract = Contract(expected=("L_ORDERKEY", "QUANTITY", "PRICE", "GHOST"), critical=frozenset({"L_ORDERKEY"}))

    def all_sections() -> None:
        _, errors = run_sections(ledger_sections(lines(), "lines", parts), scratch(spark, "bench-profile"))
        assert not errors, errors

    def silver_ledger() -> None:
        out = ledger_silver(lines(), LEDGER, RUN_AT)
        overwrite_partitions(out, scratch(spark, "bench-silver"), ["ano_particion"])

    def silver_survey() -> None:
        out = survey_silver(orders(), "orders", SURVEY_ORDERS, SURVEY, RUN_AT)
        overwrite_flat(out, scratch(spark, "bench-silver"), "survey", "orders")

    def dedup_lines() -> None:
        tie = [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]
        out = dedup.keep_first(lineitem(), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()], tie)
        out.write.format("noop").mode("overwrite").save()

    jobs = {
        "quality_scorecard": lambda: scores(orders(), SCORECARD).collect(),
        "quality_ledger_26_rules": lambda: ledger_quality(lines(), LEDGER_CONFIG, AS_OF).collect(),
        "quality_ledger_with_samples": lambda: ledger_quality(
            lines(), LEDGER_CONFIG, AS_OF, ("l_orderkey", "l_linenumber", "l_partkey")
        ).collect(),
        "quality_survey_21_rules": lambda: survey_quality({"orders": orders(), "lines": lines()}, SURVEY_CONFIG, AS_OF).collect(),
        "silver_ledger_write": silver_ledger,
        "silver_survey_write": silver_survey,
        "dedup_keep_first": dedup_lines,
        "profile_8_sections": all_sections,
        "profile_columns_rich": lambda: column_profile(orders(), "orders").collect(),
        "contract_validation": lambda: [d.collect() for d in validate_contract(lines(), contract, source="s", dataset="d")],
    }
    chosen = sys.argv[1:] or list(jobs)
    times = {}
    for name in chosen:
        start = time.perf_counter()
        jobs[name]()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds over the headline jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
