"""Print the formatted physical plan of registered queries.

usage: python scripts/explain.py [--sf DIR] key [key ...]
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="+")
    args = ap.parse_args()
    from eventlens.registry import QUERIES
    from eventlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for key in args.keys:
        print(f"===== {key}")
        QUERIES[key](spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main()
