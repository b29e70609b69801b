"""Print the formatted physical plan of registered queries (after one run, so AQE's final plan shows).

usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from tillscope.registry import queries
    from tillscope.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    qs = queries()
    for name in args:
        df = qs[name](spark, sf_dir)
        df.collect()
        print(f"===== {name}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
