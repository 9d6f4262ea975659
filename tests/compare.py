"""Run registered queries and their SQL side by side: python tests/compare.py sf0.01 [prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder: str, name: str, run, text: str) -> str:
    """Empty when both engines agree, else the first difference."""
    df = run(spark, folder)
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(text)
    right = _rows([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
            n = sum(x != y for x, y in zip(left[1], right[1]))
            return f"{n}/{len(left[1])} rows differ, first {bad[:4]} in {a[:6]}"
        for x, y in zip(a, b):
            if x is not None and type(x) is not type(y):
                return f"types {type(x)} vs {type(y)}"
    return ""


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as e

    folder, prefixes = f"/root/testdata/{sys.argv[1]}", sys.argv[2:]
    spark, con, texts = session(), connect(f"/root/testdata/{sys.argv[1]}"), e.oracle_sql()
    bad = 0
    for name, run in e.queries().items():
        if name not in texts and not prefixes:
            continue
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            n = ""
            if name in texts:
                diff = compare(spark, con, folder, name, run, texts[name])
            else:
                diff, n = "", f"rows only: {run(spark, folder).count()}"
        except Exception as err:  # noqa: BLE001
            diff = f"{type(err).__name__}: {str(err)[:600]}"
        bad += bool(diff)
        print(f"{'BAD ' if diff else 'ok  '} {name} {time.time() - start:.2f}s {n}{diff}", flush=True)
    print("bad:", bad)
