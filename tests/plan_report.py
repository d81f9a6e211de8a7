"""Prints PLANS.md: for each headline query the tables staged while the query is built (jobs that
run before the final plan) and the final adaptive plan.

    python tests/plan_report.py /root/testdata/sf0.1 > PLANS.md
"""

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registry import load_all  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import sinks  # noqa: E402

KEEP = re.compile(r"Scan parquet|Exchange|Join|Aggregate|Window|Generate|PushedFilters|ReadSchema|Subquery")


def lines(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if "Initial Plan" in line:
            break
        if KEEP.search(line):
            line = re.sub(r"#\d+L?|, \[plan_id=\d+\]|Location:.*?, (?=PartitionFilters)|\(\d+\) ", "", line)
            out.append(line.rstrip()[:170])
    return out


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan.split("Initial Plan")[0]))


def main():
    sf = sys.argv[1]
    spark = build_session(checkpoint=tempfile.mkdtemp(prefix="tidemark-plans-"))
    staged = []
    stage = sinks.cut_lineage

    def recording(df):
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = stage(df)
        staged.append((out.count(), shuffles(plan), lines(plan)))
        return out

    for m in list(sys.modules.values()):
        if getattr(m, "__name__", "").startswith("tidemark") and getattr(m, "cut_lineage", None) is stage:
            m.cut_lineage = recording
    print("# PLANS - headline queries (sf0.1, AQE on)\n\nMade by `tests/plan_report.py`. Per query: the tables "
          "that jobs stage while the query is built, as the reference materialises its stored targets, purged staging and "
          "temp sources, with the shuffles of each; then the final adaptive plan (scans, exchanges, joins, aggregates and "
          "windows only). One-row watermark and duplicate-key aggregates are further small jobs.\n\n"
          "| query | staged tables: rows (shuffles) | shuffles in the final plan |\n|---|---|---|")
    body = []
    for e in load_all().values():
        if not e.headline:
            continue
        for m in list(sys.modules.values()):
            if getattr(m, "__name__", "").startswith("tidemark") and getattr(m, "cut_lineage", None) is stage:
                m.cut_lineage = recording
        staged.clear()
        df = e.build(spark, sf)
        before = list(staged)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| `{e.key}` | {', '.join(f'{n} ({s})' for n, s, _ in before) or '-'} | {shuffles(plan)} |")
        body.append(f"\n### {e.key}\n\n```\n" + "\n".join(lines(plan)) + "\n```")
    print("\n".join(body))


if __name__ == "__main__":
    main()
