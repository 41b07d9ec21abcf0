"""``python -m pageatlas``: the version, the directory stage, and the tables of a store."""

from __future__ import annotations

import argparse
import logging

from pageatlas import __version__


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="pageatlas")
    p.add_argument("--verbose", action="store_true", help="log what is done; requests of HTTP clients stay silent")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    d = sub.add_parser("directory", help="take over a directory file")
    for name in ("root", "file", "day"):
        d.add_argument(name)
    got = p.parse_args(args)
    logging.basicConfig(level=logging.INFO if got.verbose else logging.WARNING)
    for client in ("httpx", "urllib3", "py4j"):
        logging.getLogger(client).setLevel(logging.WARNING)
    if got.command == "version":
        print(__version__)
        return 0
    from pyspark.sql import SparkSession

    from pageatlas.engine import Engine

    with open(got.file, encoding="utf-8") as f:
        print(Engine(SparkSession.builder.getOrCreate(), got.root).directory(f.read(), got.day))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
