"""Print the formatted physical plan of catalog queries.

    python tools/explain.py [--sf-dir DIR] [--no-broadcast] name [name ...]

``--no-broadcast`` disables size-based broadcast joins, which shows the plan
shape a large cluster gets when no dimension fits the broadcast threshold.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("--no-broadcast", action="store_true")
    parser.add_argument("names", nargs="+")
    args = parser.parse_args()

    from marginlens.plans import catalog
    from marginlens.plans.session import local_session

    spark = local_session()
    if args.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in args.names:
        print(f"===== {name}")
        catalog.QUERIES[name](spark, args.sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
