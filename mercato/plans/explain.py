"""Physical-plan summaries: the operators that decide cost at scale.

``plan_summary(df)`` keeps the lines of the executed plan that show data
movement and pruning (exchanges, joins, aggregates, windows, scans with their
pushed filters and read schema).  ``python -m mercato.plans.explain SF_DIR``
writes the summaries of the main builders, read back from a pipeline run, as
Markdown.
"""

from __future__ import annotations

import os
import re
import sys

from pyspark.sql import DataFrame

KEEP = re.compile(r"Exchange|Join|HashAggregate|ObjectHashAggregate|SortAggregate|Window|"
                  r"WindowGroupLimit|FileScan|Scan ExistingRDD|Expand|Generate|TakeOrdered")


def _short(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r"Location: [^,]*, ", "", line)
    line = re.sub(r"\[plan_id=\d+\]", "", line)
    return line[:220]


def plan_summary(df: DataFrame) -> list[str]:
    """Cost-relevant lines of ``df``'s physical plan (after AQE when it has run)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [_short(line) for line in plan.splitlines() if KEEP.search(line)]


def main(sf_dir: str) -> None:
    from mercato.plans import pipeline
    from mercato.sources import sinks
    from mercato.session import local_session

    spark = local_session(app_name="mercato-explain")
    root = sinks.scratch_path(spark, "explain")
    pipeline.run_all(spark, sf_dir, root, workers=4)
    gold_root, silver_root = os.path.join(root, "gold"), os.path.join(root, "silver")
    g = pipeline.Gold(pipeline.read_silver(spark, silver_root))
    m = pipeline.marts_from_gold(spark, gold_root, silver_root)
    frames = {
        "gold: fact_orders (from silver)": g.fact_orders,
        "gold: fact_order_items (from silver)": g.fact_order_items,
        "mart: metrics_revenue": m.metrics_revenue,
        "mart: item roll-up shared by three marts": m.item_rollup,
        "mart: metrics_revenue_by_seller": m.metrics_revenue_by_seller,
        "mart: metrics_reviews_by_category": m.metrics_reviews_by_category,
        "mart: metrics_cohort": m.metrics_cohort,
        "mart: metrics_abc": m.metrics_abc,
    }
    out = ["# Physical plans (sf %s, local mode, after AQE)" % os.path.basename(sf_dir), ""]
    for title, df in frames.items():
        df.write.format("noop").mode("overwrite").save()
        out += [f"## {title}", "", "```"] + plan_summary(df) + ["```", ""]
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
