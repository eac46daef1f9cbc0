"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] [--out PLANS.md] [key ...]

Per query: shuffles (Exchange), broadcasts, Python stages (Arrow / pandas),
whole-stage-codegen stages, parquet scans with their read schema and pushed
filters.  Plans are the initial adaptive plans (AQE may still coalesce,
broadcast or split skewed partitions at run time)."""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PY_NODES = ("ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInPandasWithState", "FlatMapGroupsInArrow")


def final_section(plan: str) -> str:
    """Tree and details of the final adaptive plan only (drops the
    "Initial Plan" subtree and the details of its nodes)."""
    if "== Final Plan ==" not in plan:
        return plan
    tree_end = plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else len(plan)
    tree = plan[: tree_end]
    ids = set(re.findall(r"\((\d+)\)", tree[plan.index("== Final Plan =="):]))
    details = plan[plan.index("\n\n", tree_end) if "\n\n" in plan[tree_end:] else tree_end :]
    blocks = re.split(r"\n(?=\(\d+\) )", details)
    keep = [b for b in blocks if (m := re.match(r"\((\d+)\) ", b)) and m.group(1) in ids]
    return tree + "\n" + "\n".join(keep)


def summarise(plan: str) -> dict:
    heads = re.findall(r"^\(\d+\) (\S+(?: \S+)?)", plan, flags=re.M)
    names = [h.split(" [")[0] for h in heads]
    shuffles = sum(1 for n in names if n == "Exchange")
    broadcasts = sum(1 for n in names if n == "BroadcastExchange")
    python = sorted({n for n in names if n in PY_NODES})
    codegen = len(set(re.findall(r"\[codegen id : (\d+)\]", plan)))
    scans = re.findall(r"Location: InMemoryFileIndex \[file:([^\]]+)\]", plan)
    tables = sorted({os.path.basename(s).replace(".parquet", "") for s in scans})
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p})
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)))
    return {
        "shuffles": shuffles,
        "broadcasts": broadcasts,
        "python": ", ".join(python) or "—",
        "codegen_stages": codegen,
        "tables": ", ".join(tables) or "(staged)",
        "pushed": "; ".join(pushed) or "—",
        "widest_read": max(schemas, key=len) if schemas else "—",
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    ap.add_argument("--final", action="store_true", help="execute each query first and report its final adaptive plan")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from cadence.plans.catalog import QUERIES
    from cadence.session import get_spark

    spark = get_spark()
    rows = []
    for k in a.keys or sorted(QUERIES):
        df = QUERIES[k](spark, a.sf)
        if a.final:
            # run this DataFrame's own query execution in the JVM (no rows
            # into Python) so AQE settles its final plan
            df._jdf.queryExecution().toRdd().count()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        rows.append((k, summarise(final_section(text) if a.final else text)))
        print(k, rows[-1][1]["shuffles"], flush=True)
    with open(a.out, "w") as fh:
        fh.write("# Physical plans of the registered queries\n\n")
        kind = "final adaptive plans, after execution" if a.final else "initial adaptive plans"
        fh.write(f"Generated by `tools/plan_report.py{' --final' if a.final else ''}` at `{a.sf}` ({kind}).\n")
        fh.write("Shuffles = `Exchange` nodes; Python = Arrow / pandas stages (all batch-vectorised).\n\n")
        fh.write("| query | shuffles | broadcasts | codegen stages | Python stages | tables | pushed filters | widest read schema |\n")
        fh.write("|---|---|---|---|---|---|---|---|\n")
        for k, r in rows:
            fh.write(
                f"| `{k}` | {r['shuffles']} | {r['broadcasts']} | {r['codegen_stages']} | {r['python']} | {r['tables']} | "
                f"{r['pushed'].replace('|', '/')} | `{r['widest_read']}` |\n"
            )


if __name__ == "__main__":
    main()
