"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs over whole tables into the ``noop`` sink, so that the time is
Spark's work and not the transfer of rows to Python.  The layers a query needs
(daily performance, feature store, plan, ...) are built first and timed under
their own names, the way the nightly job builds them.
"""

import json
import os
import tempfile
import time

from outpulse.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = (
    "staged_sends", "send_fact", "normalised_reports", "report_fact_upsert", "daily_performance", "feature_store", "template_features", "template_performance",
    "style_lift", "slot_ranking", "schedule_recommendations", "slot_recommendations", "weekly_plan", "preliminary_ranking", "diverse_ranking", "weighted_ranking",
    "schedule_export", "smart_cooldowns", "send_links", "performance_alerts", "volume_advice", "timing_regularity", "revenue_projections", "opportunity_ranking",
    "enhanced_plan", "account_leaderboard", "data_quality_check", "template_inflow", "content_audit", "mapped_names", "upserted_facts", "streamed_facts", "streamed_daily_totals",
)


def main() -> None:
    spark = build_session(
        "outpulse-bench", f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="outpulse-bench-")},  # one machine: its own folder is shared
    )
    spark.sparkContext.setLogLevel("ERROR")
    from outpulse.catalog import load_products
    from outpulse.sources import driver_tables as src

    products = load_products()
    src.table(spark, SF_DIR, "events").count()  # JVM warm-up
    times = {}
    for name in QUERIES:
        start = time.time()
        products[name].frame(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    landed = src.table(spark, SF_DIR, "events").count()
    line = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": SF_DIR.rstrip("/").split("sf")[-1],
        "normalise_and_dedup_rows_per_sec": round(landed / times["normalised_reports"]),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
