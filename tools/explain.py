"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] [key ...]   (default: both attributions at sf0.01)

Runs each query once into the ``noop`` sink first so the size checks have
run and the printed plan is the one that executed (adaptive re-planning
shown as the final plan).
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from creditmap import catalog  # noqa: E402
from creditmap.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["market_share_attribution", "sales_assets_attribution"]
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    for name in names:
        df = catalog.build(name, spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"==== {name} ====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
