"""Compares registered queries with their DuckDB texts: check_all.py [folder] [name part ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tillroll.session import local_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con = local_session("check"), connect(folder)
    texts, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in texts:
                found = differences(df, con, texts[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as problem:  # report and go on with the next query
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(found)
        state = "DIFF" if found else ("ok  " if name in texts else "rows")
        print(f"{state} {name} {time.time() - start:.2f}s", *found, sep="\n      " if found else " ")
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
