"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from viewlog.plans.catalog import QUERIES  # noqa: E402
from viewlog.session import get_spark  # noqa: E402

if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:]
    spark = get_spark("local[8]", 8)
    for n in names:
        print(f"===== {n}")
        QUERIES[n](spark, sf).explain("formatted")
    spark.stop()
