"""Command line: run a registered query over a data folder and write or show its result."""

from __future__ import annotations

import argparse

from .plans import queries
from .session import local_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    parser.add_argument("query", help="name of a query, or 'list'")
    parser.add_argument("--data", default=".", help="folder of Parquet tables")
    parser.add_argument("--out", help="folder to write Parquet to; without it the first rows are shown")
    parser.add_argument("--limit", type=int, default=20)
    parser.add_argument("--strict", action="store_true", help="exit with 1 if the result has rows (for gates)")
    args = parser.parse_args(argv)
    if args.query == "list":
        print("\n".join(sorted(queries.QUERIES)))
        return 0
    if args.query not in queries.QUERIES:
        parser.error(f"no query {args.query}")
    result = queries.QUERIES[args.query](local_session(), args.data)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(args.limit, truncate=80)
    return int(args.strict and not result.isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
