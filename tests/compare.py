"""Compare registered queries with their SQL counterparts: `python tests/compare.py [sf_dir] [query …]`."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def expected(sql: str, sf: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    con.execute("SET TimeZone='UTC'")
    return con.execute(sql).df()


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(actual: pd.DataFrame, wanted: pd.DataFrame) -> list[str]:
    if sorted(actual.columns) != sorted(wanted.columns):
        return [f"columns {sorted(actual.columns)} / {sorted(wanted.columns)}"]
    found = []
    kinds = {c: (actual[c].dtype.kind, wanted[c].dtype.kind) for c in actual.columns}
    with_null = {c for c in actual.columns if actual[c].isna().any()}  # whole numbers with a null are floats in pandas
    found += [
        f"type of {c}: {actual[c].dtype} / {wanted[c].dtype}"
        for c, (a, b) in kinds.items() if a != b and not (c in with_null and {a, b} == {"f", "i"})
    ]
    if len(actual) != len(wanted):
        return [*found, f"rows {len(actual)} / {len(wanted)}"]
    pairs = [(a, b) for a, b in zip(normal(actual), normal(wanted)) if a != b]
    return found + [f"{len(pairs)} rows differ, first {str(pairs[0])[:400]}"] if pairs else found


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = e.queries(), e.oracle_sql()
    bad = []
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            actual = queries[name](spark, sf).toPandas()
            took = time.time() - began
            found = differences(actual, expected(oracle[name], sf)) if name in oracle else []
            status = "rows only" if name not in oracle else "ok" if not found else f"DIFFERS {found}"
            print(f"{name}: {status} ({len(actual)} rows, {took:.1f}s, oracle {time.time() - began - took:.1f}s)", flush=True)
        except Exception as error:
            found = [str(error)[:1500]]
            print(f"{name}: FAILED {found}", flush=True)
        if found:
            bad.append(name)
    print("bad:", bad)
