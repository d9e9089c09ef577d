"""Command line: the daily run, the incremental ingest, and the dashboard cards.

    python -m parcelscope daily  --source DIR --lake DIR [--buckets N]
    python -m parcelscope ingest --landing DIR --lake DIR
    python -m parcelscope card   --lake DIR NAME [--source warehouse|stream|rollup] [--param key=value ...] [--out DIR]

``ingest`` appends newly landed files, cleans them and brings the stored sums up to date.
``card`` reads the loaded tables of the lake and runs one card from
``plans.metrics`` (``q1a_delivery_stats`` ... ``q8b_state_late_freight``,
``estimate_gap``); with ``--source stream`` the tables of the ingest, with ``--source rollup`` the stored sums
(cards 1a-2d, 5a, 5b).  ``--out`` writes the result as Parquet, otherwise every row is
printed, tab-separated.  ``--cluster`` before the command applies the settings for a large cluster.
"""

from __future__ import annotations

import argparse
import sys

from .plans import metrics as M
from .plans import rollup
from .schema import TABLES
from .session import CLUSTER_CONF, build_session
from .sources import zones
from .streaming import refine
from .streaming.ingest import ingest_new_files

CARDS = {**M.QUERIES, "estimate_gap": M.estimate_gap}


class LoadedTables(dict):
    """The warehouse tables of a lake, read when a card asks for them."""

    def __init__(self, spark, lake: str):
        super().__init__()
        self.spark, self.lake = spark, lake

    def __missing__(self, name: str):
        self[name] = zones.read_zone(self.spark, self.lake, zones.WAREHOUSE, name)
        return self[name]


def _params(pairs: list[str]) -> dict:
    out = {}
    for p in pairs:
        k, v = p.split("=", 1)
        out[k] = int(v) if v.lstrip("-").isdigit() else v
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="parcelscope")
    ap.add_argument("--cluster", action="store_true", help="settings for a large cluster")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="extract, transform and load every source CSV")
    d.add_argument("--source", required=True)
    d.add_argument("--lake", required=True)
    d.add_argument("--buckets", type=int, default=None)
    i = sub.add_parser("ingest", help="append newly landed CSV files, clean them and update the stored sums")
    i.add_argument("--landing", required=True)
    i.add_argument("--lake", required=True)
    c = sub.add_parser("card", help="run one dashboard card over the clean zone")
    c.add_argument("--lake", required=True)
    c.add_argument("name", choices=sorted(CARDS))
    c.add_argument("--source", choices=("warehouse", "stream", "rollup"), default="warehouse")
    c.add_argument("--param", action="append", default=[], help="card parameter, e.g. min_rows=190")
    c.add_argument("--out", default=None)
    args = ap.parse_args(argv)

    spark = build_session(extra=CLUSTER_CONF if args.cluster else None)
    if args.cmd == "daily":
        zones.run_daily(spark, args.source, args.lake, buckets=args.buckets).show(len(TABLES), truncate=False)
    elif args.cmd == "ingest":
        for name, n in ingest_new_files(spark, args.landing, args.lake).items():
            print(f"{name:25s} {n:>12,d} rows appended")
        refine.refine_new_rows(spark, args.lake)
        rollup.update(spark, args.lake)
        refine.refined_audit(spark, args.lake).show(len(TABLES), truncate=False)
    else:
        params = _params(args.param)
        if args.source == "rollup":
            df = rollup.CARDS[args.name](spark, args.lake, **params)
        else:
            tables = refine.RefinedTables(spark, args.lake) if args.source == "stream" else LoadedTables(spark, args.lake)
            df = CARDS[args.name](tables, **params)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            print("\t".join(df.columns))
            for row in df.toLocalIterator():
                print("\t".join("" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
