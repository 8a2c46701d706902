"""Run queries next to their oracles in DuckDB: ``python -m workload.check [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time

import pandas as pd


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False):
        cells = []
        for v in row:
            if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
                cells.append("~")
            elif isinstance(v, float):
                cells.append(repr(v + 0.0))
            elif isinstance(v, pd.Timestamp):
                cells.append(v.isoformat())
            elif hasattr(v, "isoformat"):
                cells.append(pd.Timestamp(v).isoformat())
            elif hasattr(v, "item"):
                cells.append(repr(v.item()))
            else:
                cells.append(repr(v))
        rows.append(tuple(cells))
    return sorted(rows)


def compare(spark, con, sf_dir: str, name: str, run, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    left = run(spark, sf_dir).toPandas()
    took = time.time() - start
    if sql is None:
        return len(left) > 0, f"{len(left)} rows, no oracle, {took:.1f}s"
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    for c in left.columns:
        if pd.api.types.is_integer_dtype(left[c]) != pd.api.types.is_integer_dtype(right[c]):
            kinds = (left[c].dtype, right[c].dtype)
            both_float = left[c].isna().any() or right[c].isna().any()
            if not both_float:
                return False, f"type of {c}: {kinds}"
    a, b = canonical(left), canonical(right)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{len(a)}/{len(b)} rows, first differences {bad} of {sorted(left.columns)}"
    return True, f"{len(a)} rows, {took:.1f}s"


def main(argv: list[str]) -> int:
    import duckdb

    from tidewatch.session import build_session
    from workload import ORACLES, QUERIES
    from workload.views import TABLES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = build_session(
        "check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    failed = 0
    for name in wanted:
        try:
            ok, note = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} good")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
