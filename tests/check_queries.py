"""Run queries beside their SQL: python tests/check_queries.py <folder> [name ...]"""

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from matchwright import session  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main(folder, wanted):
    session.LOCAL_SETTINGS["spark.ui.showConsoleProgress"] = "false"
    spark = session.local_session("check", 8)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    failed = []
    for name, run in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            got = [tuple(r) for r in df.collect()]
            seconds = time.time() - start
            sql = contract.oracle_sql().get(name)
            if sql is None:
                verdict = "rows only"
            else:
                res = db.execute(sql)
                names = [d[0] for d in res.description]
                want = res.fetchall()
                a, b = bag(df.columns, got), bag(names, want)
                same = sorted(df.columns) == sorted(names) and a == b
                verdict = "ok" if same else f"DIFF want {len(want)}"
                if not same:
                    failed.append(name)
                    print(sorted(df.columns), sorted(names))
                    print("  only spark ", list((a - b).items())[:3])
                    print("  only duckdb", list((b - a).items())[:3])
        except Exception as error:  # noqa: BLE001
            seconds, verdict, got = time.time() - start, f"ERROR {str(error)[:600]}", []
            failed.append(name)
        print(f"{name:24s} {seconds:6.1f}s {len(got):8d} rows  {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
