"""Print the physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] [--no-broadcast] [query ...]

``--no-broadcast`` sets ``spark.sql.autoBroadcastJoinThreshold=-1`` to show
the plan large inputs get (explicit, size-checked broadcasts remain).
Queries that fit models while being built run those fits first.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    sf_dir = next((a for a in argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    from maillens.plans.catalog import QUERIES
    from maillens.session import build_session

    spark = build_session()
    if "--no-broadcast" in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in names or ["insider_features", "term_stats", "tfidf", "mail_parse"]:
        print(f"===== {name}")
        QUERIES[name].build(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
