"""Run registered queries next to their SQL oracles and compare the values."""

from __future__ import annotations

import datetime as dt
import math
import pathlib
import sys

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(canonical(r[k]) for k in order) for r in rows)


def differences(spark_df, con, sql) -> list[str]:
    """Empty when both sides agree on columns, rows and values."""
    mine = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    answer = con.execute(sql)
    theirs = table([d[0] for d in answer.description], answer.fetchall())
    if mine[0] != theirs[0]:
        return [f"columns {mine[0]} != {theirs[0]}"]
    if mine[1] == theirs[1]:
        return []
    a, b = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
    found = [f"rows {len(mine[1])} vs {len(theirs[1])}, {len(a)} only in Spark, {len(b)} only in SQL"]
    if a and b:
        x = sorted(a)[0]
        y = max(sorted(b), key=lambda r: sum(p == q for p, q in zip(r, x)))
        found += [f"{n}: {p} != {q}" for n, p, q in zip(mine[0], x, y) if p != q]
    return found


if __name__ == "__main__":
    import time

    sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from creditloom import session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con, oracles = session.local_session(8), connect(sf_dir), oracle_sql()
    spark.sparkContext.setLogLevel("ERROR")
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
                verdict = "equal" if not found else "DIFFERS " + "; ".join(found)[:600]
            else:
                verdict = f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001 - report every query
            text = str(error)
            at = text.find("Caused by")
            verdict = "FAILED " + (text[:300] + (" ... " + text[at : at + 900] if at > 0 else "")).replace("\n", " | ")
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
