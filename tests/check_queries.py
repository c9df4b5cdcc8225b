"""Run registered queries against their SQL: python tests/check_queries.py [folder] [name ...]"""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as entry  # noqa: E402
from millrace.session import build_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql, bad = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sql:
                problem = compare(df, sql[name], con)
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
                if names:
                    print(df.columns, rows[:4])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        kind = "sql " if name in sql else "rows"
        print(f"{'OK  ' if problem is None else 'FAIL'} {kind} {name:24s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {' '.join(bad)}")


main()
