"""Run a query of the catalogue over a folder of tables: ``python -m caselake NAME FOLDER [--out PATH] [--master URL]``."""

from __future__ import annotations

import argparse

from caselake.plans import catalogue, rendered, round_trips  # noqa: F401
from caselake.session import session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="caselake")
    p.add_argument("name", nargs="?", help="a query; without one, all names are listed")
    p.add_argument("folder", nargs="?", help="where the tables lie, as <folder>/<table>.parquet")
    p.add_argument("--out", help="write the result there as Parquet instead of showing it")
    p.add_argument("--master")
    args = p.parse_args(argv)
    if not args.name:
        print("\n".join(catalogue.QUERIES))
        return
    if args.name not in catalogue.QUERIES or not args.folder:
        p.error("a query of the list and a folder are needed")
    spark = session("caselake", args.master)
    result = catalogue.QUERIES[args.name](spark, args.folder)
    result.write.mode("overwrite").parquet(args.out) if args.out else result.show(truncate=60)


if __name__ == "__main__":
    main()
