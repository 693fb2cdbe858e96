"""Compare every query with its SQL at one scale: ``python tests/check_all.py [dir] [name...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402
from conftest import make_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = make_session()
    con = oracle.connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            columns, rows = oracle.spark_rows(df)
            took = time.time() - start
            if name not in sqls:
                print(f"ROWS  {name:32s} {len(rows):7d} rows {took:6.2f}s")
                continue
            expected_columns, expected = oracle.sql_rows(con, sqls[name])
            ok = columns == expected_columns and rows == expected
            print(
                f"{'ok   ' if ok else 'DIFF '} {name:32s} {len(rows):7d} rows {took:6.2f}s "
                f"{'; '.join(oracle.type_differences(df, con, sqls[name]))}",
                flush=True,
            )
            if not ok:
                bad += 1
                print("   columns", columns, expected_columns, "rows", len(rows), len(expected))
                mine, theirs = set(rows), set(expected)
                print("   only spark", [r for r in rows if r not in theirs][:4])
                print("   only sql  ", [r for r in expected if r not in mine][:4])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
