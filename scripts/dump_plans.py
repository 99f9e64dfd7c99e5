"""Write the formatted physical plan of each headline report to docs/plans/.

Usage: python scripts/dump_plans.py [sf_dir]

Auto-broadcast is switched off so the files show the plan Spark picks for
large inputs. Run on the local test files, the plans also contain the adapters'
own aggregates (visits, calendar), which stored tables do not have.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import bench  # noqa: E402
from cohortline.plans.catalog import QUERIES  # noqa: E402
from cohortline.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for key in bench.HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[key](spark, sf_dir).explain("formatted")
        text = re.sub(r"#\d+L?", "", buf.getvalue())  # expression ids change per run
        text = re.sub(r", \[plan_id=\d+\]", "", text)
        text = text.replace("\x00", "\\u0000")  # the null-key stand-in prefix
        with open(os.path.join(out_dir, f"{key}.txt"), "w") as f:
            f.write(text)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
