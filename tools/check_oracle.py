"""Run every registered query next to its SQL and compare rows, columns and values.

    python tools/check_oracle.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.catalog import ORACLE, QUERIES  # noqa: E402
from riskloom.session import local_session  # noqa: E402

KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "FLOAT": "float"}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:])
    spark = local_session("check", spark__ui__showConsoleProgress="false")
    db = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    failed = 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            seconds = time.perf_counter() - start
            note = "rows only"
            if name in ORACLE:
                answer = db.execute(ORACLE[name])
                columns = [c[0] for c in answer.description]
                types = {c[0]: str(c[1]) for c in answer.description}
                want = answer.fetchall()
                mine, theirs = rows_of(df.columns, got), rows_of(columns, want)
                note = "ok"
                if sorted(df.columns) != sorted(columns):
                    note = f"COLUMNS {sorted(df.columns)} {sorted(columns)}"
                elif len(mine) != len(theirs):
                    note = f"ROWS {len(mine)} {len(theirs)}"
                elif mine != theirs:
                    odd = [(a, b) for a, b in zip(mine, theirs) if a != b]
                    note = f"VALUES {len(odd)} of {len(mine)}: {odd[:2]}"
                else:
                    odd = {c: (t, types[c]) for c, t in df.dtypes
                           if KINDS.get(types[c], types[c]) != t}
                    if odd:
                        note = f"TYPES {odd}"
            if not got:
                note += " EMPTY"
        except Exception as error:  # report and go on
            seconds, got = time.perf_counter() - start, []
            note = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += note not in ("ok", "rows only")
        print(f"{name:32s} {seconds:6.2f}s {len(got):7d} rows  {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
