"""Print the physical plan of registered queries.

    python tools/explain.py [--sf DIR] [--mode formatted|simple|cost] name [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockroom.registry import QUERIES  # noqa: E402
from stockroom.session import get_spark  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    spark = get_spark("local[8]", shuffle_partitions=8)
    for n in a.names:
        print(f"===== {n}")
        QUERIES[n](spark, a.sf).explain(a.mode)


if __name__ == "__main__":
    main()
