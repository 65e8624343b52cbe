"""Write PLANS.md: the physical plan tree of every registered key.

Usage: python scripts/explain_plans.py [sf_dir]
Keeps the operator tree of ``explain("formatted")`` plus, per scan, the
pushed filters and read schema, so plan shape can be reviewed without
running anything.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bazaarlens.plans.registry import QUERIES  # noqa: E402
from bazaarlens.session import get_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> list[str]:
    lines = text.splitlines()
    out, i = [], 0
    # the operator tree: lines up to the first blank line after the header
    for line in lines[1:]:
        if not line.strip():
            break
        out.append(line)
    scans = []
    for j, line in enumerate(lines):
        if re.match(r"^\(\d+\) Scan ", line):
            block = []
            for k in lines[j + 1:]:
                if not k.strip() or re.match(r"^\(\d+\) ", k):
                    break
                if k.startswith(("PushedFilters", "ReadSchema")):
                    block.append("    " + k)
            scans.append(line + "\n" + "\n".join(block))
    if "===== Subqueries =====" in text:
        out.append("  (+ scalar subquery)")
    return out + (["", "Scans:"] + scans if scans else [])


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    parts = ["# PLANS", "",
             f"Physical plans of every registered key (`scripts/explain_plans.py`, {sf_dir}, "
             "before adaptive re-planning). Generated; do not edit.", ""]
    for k, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        parts += [f"## {k}", "", "```"] + summarise(plan_text(df)) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
