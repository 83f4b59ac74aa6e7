"""Write the final (adaptive) physical plan of every registered query to PLANS.md, and
beside it the plan with automatic broadcasts off - the one that holds where both sides of a
join are large.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Each query is executed into the no-op sink, so the adaptive plan is final: it shows the join
strategies, group limits, pushed filters and the columns each scan reads.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan_of(spark, fn, sf_dir: str, width: int = 200) -> str:
    """The plan that ran, from the DataFrame's own execution."""
    df = fn(spark, sf_dir)
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    return "\n".join(line if len(line) <= width else line[: width - 3] + "..." for line in plan.splitlines()).rstrip()


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from demandlens.plans.queries import QUERIES
    from demandlens.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        f"# Physical plans ({os.path.basename(sf_dir)}, local[8], final adaptive plans)\n",
        "Lines are cut at 200 characters. At this size Spark broadcasts the small sides of the fact joins "
        "(their initial plans show it already). The second plan of a query, given where it differs in its joins, "
        "ran with automatic broadcasts off: only sides of a measured size are broadcast there.\n",
    ]
    for name, fn in QUERIES.items():
        plan = plan_of(spark, fn, sf_dir)
        out.append(f"## {name}\n\n```\n{plan}\n```\n")
        old = {k: spark.conf.get(k, None) for k in THRESHOLDS}
        for k in THRESHOLDS:
            spark.conf.set(k, "-1")
        other = plan_of(spark, fn, sf_dir)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        if other.count("SortMergeJoin") != plan.count("SortMergeJoin"):
            out.append(f"Broadcasts off:\n\n```\n{other}\n```\n")
        print(name, flush=True)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
