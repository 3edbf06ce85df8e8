"""``python -m tallyspan QUERY DATA OUT``: run a registered query on a folder of tables and write its rows as parquet, CSV or JSON lines by the ending of OUT; ``--report`` prints the verdicts of the document checks instead. Exit code 0 if rows came out, 1 if none, 2 for an unknown query."""

from __future__ import annotations

import argparse
import sys

from tallyspan.plans import registry
from tallyspan.session import local_session
from tallyspan.sinks import files


def main(argv: list[str] | None = None, spark=None) -> int:
    args = argparse.ArgumentParser(prog="tallyspan", description=__doc__)
    args.add_argument("query", help="name of a query, or `list`")
    args.add_argument("data", nargs="?")
    args.add_argument("out", nargs="?")
    args.add_argument("--report", action="store_true", help="count the verdicts of check_report")
    told = args.parse_args(argv)
    if told.query == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    if told.query not in registry.QUERIES or told.data is None:
        return 2
    df = registry.QUERIES[told.query](spark or local_session(), told.data)
    if told.report and {"part", "line_no", "line"} <= set(df.columns):
        for r in df.where("line_no = 0").groupBy("part", "line").count().orderBy("part", "line").limit(100).collect():
            print(f"{r['count']:>8}  {r.line}")
        return 0
    if told.out is None:
        df.show(50, truncate=60)
        return 0 if df.limit(1).count() else 1
    if told.out.endswith(".csv"):
        files.write_csv(df, told.out)
    elif told.out.endswith(".json"):
        df.write.mode("overwrite").json(told.out)
    else:
        df.write.mode("overwrite").parquet(told.out)
    return 0 if df.limit(1).count() else 1


if __name__ == "__main__":
    sys.exit(main())
