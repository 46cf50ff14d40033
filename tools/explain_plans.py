"""Write docs/PLANS.md: formatted physical plans of the key steps.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from branchbook.operators import allocation, ratios as R  # noqa: E402
from branchbook.plans.books import Books  # noqa: E402
from branchbook.session import local_session  # noqa: E402
from branchbook.sources import seeds  # noqa: E402


def formatted(df) -> str:
    df.count()  # so the adaptive plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return re.sub(r"file:/\S+/(\w+\.parquet|[\w-]+)\]", r"\1]", text)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    b = Books.from_testdata(spark, sf, materialize="table", strict=False)
    stored = tempfile.mkdtemp(prefix="branchbook-plans-")
    b.txn.write.parquet(f"{stored}/postings")
    postings = spark.read.parquet(f"{stored}/postings")
    sel = [(k, v) for _, (_, k, vals) in seeds.ALLOCATED_LINES.items() for v in vals]
    steps = [
        ("Posting aggregate from a stored posting table (one scan, pushed selector filter, pruned columns, "
         "broadcast bridge, partial aggregation before the only shuffle)",
         allocation.line_postings_monthly(postings, seeds.line_selector_df(spark), seeds.prefix_lengths(), sel)),
        ("Snapshot cells (one scan for all 7 methods and the NPL step)",
         R.snapshot_cells(b.snapshot, b.provinces)),
        ("Allocation ratios from the cells (prefix sums per area, handed to the report months of an interval)",
         R.allocation_ratios(b.snapshot, b.kpi_asm, b.provinces, b.areas, b.months, strict=False, cells=b.cells,
                             headcount=b.headcount_cells)),
        ("Allocated lines (cumulative postings + ratio spine)",
         allocation.allocate_lines(b.cumulative_postings, b.ratios, seeds.line_catalog_df(spark))),
        ("The eight ranks (one range exchange, written; then prefix sums, key join, row join)", b.asm_ranked),
    ]
    out = ["# Physical plans of the key steps", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf.rstrip('/'))}` (local[*], AQE on); "
           "final adaptive plans.", ""]
    for title, df in steps:
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path, sum(len(x) for x in out))


if __name__ == "__main__":
    main()
