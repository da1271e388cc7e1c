"""Summarise the physical plan of every registered query (for PLANS.md).

    python tools/plan_report.py [sf_dir] [broadcast_threshold_bytes] > PLANS.md

Plans are taken with a tiny automatic-broadcast threshold (10 KB by
default): only the fixed-size dimensions (25 nations, 5 regions) still
broadcast on their own, while ``events`` and ``customer`` join by key, the
shape a cluster gets at scale.  Explicit broadcasts (sizes bounded by
construction) are counted separately.  Keys whose callables write or fit
first (sinks, splits, models) are planned after that work, over what it
stored.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    ops = re.findall(r"^[\s:+|-]*([A-Z][A-Za-z]*)\b[^\n]*\(\d+\)$", tree, re.M)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "exchanges": ops.count("Exchange"),
        "broadcasts": ops.count("BroadcastExchange"),
        "smj": ops.count("SortMergeJoin"),
        "bhj": ops.count("BroadcastHashJoin"),
        "windows": sum(1 for o in ops if o == "Window"),
        "group_limits": sum(1 for o in ops if o == "WindowGroupLimit"),
        "partial_aggs": len(re.findall(r"partial_", plan)) > 0,
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "widest_scan": max((len(s.split(",")) for s in scans), default=0),
        "python_udf": "BatchEvalPython" in plan or "ArrowEvalPython" in plan,
    }


def main(argv) -> None:
    from roadlake.session import local_session

    from roadlake.plans.queries import registry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    threshold = argv[1] if len(argv) > 1 else "10240"
    spark = local_session(cpus=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` with `autoBroadcastJoinThreshold={threshold}`:")
    print("only the fixed-size dimensions (25 nations, 5 regions) broadcast automatically, `events` and")
    print("`customer` join by key, as they do at scale. Keys that write or fit first (sinks, split,")
    print("model) are planned over what that work stored (a checkpoint or a written table).")
    print("Exchange = shuffle; SMJ/BHJ = sort-merge/broadcast hash joins; WGL = WindowGroupLimit")
    print("(partial + final = the dedup limit runs before the shuffle); pushed = scans with")
    print("pushed filters; widest scan = most columns read from one file.\n")
    print("| Key | Exchanges | Broadcasts | SMJ | BHJ | Windows | WGL | Partial agg | Pushed | Widest scan | Python UDF |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    for key, fn in registry().items():
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        s = summarize(buf.getvalue())
        print(f"| `{key}` | {s['exchanges']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['windows']} | "
              f"{s['group_limits']} | {'yes' if s['partial_aggs'] else '-'} | {s['pushed']} | "
              f"{s['widest_scan']} | {'YES' if s['python_udf'] else 'no'} |")


if __name__ == "__main__":
    main(sys.argv[1:])
