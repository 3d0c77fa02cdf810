"""Write every registered query's formatted physical plan to a folder.

Usage: python scripts/explain_all.py [sf_dir] [out_dir]
(out_dir defaults to a fresh folder under /tmp).  Model queries train when
built, so they are skipped.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans import ORACLE, QUERIES  # noqa: E402
from quarry.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="quarry-plans-")
    os.makedirs(out, exist_ok=True)
    spark = local_session(cores=8)
    for name, fn in QUERIES.items():
        if name not in ORACLE:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(plan)
    print(out)


if __name__ == "__main__":
    main()
