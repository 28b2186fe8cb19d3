"""Compare registered queries with their SQL twins in DuckDB: columns, types, and every value."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
}


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and value == 0.0:
        return 0.0
    return tuple(value) if isinstance(value, list) else value


def compare(spark, con, name, query, sql, sf_dir):
    """Problems found, empty when both sides agree."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    rows = [tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    if sorted(duck_names) != names:
        return [f"columns {names} != {sorted(duck_names)}"]
    duck_types = {d[0]: str(d[1]) for d in result.description}
    spark_types = dict(df.dtypes)
    problems = [
        f"type of {n}: {spark_types[n]} != {duck_types[n]}"
        for n in names
        if TYPE_NAMES.get(duck_types[n], duck_types[n].lower()) != spark_types[n]
    ]
    at = [duck_names.index(n) for n in names]
    expected = [tuple(_cell(r[i]) for i in at) for r in result.fetchall()]
    left, right = Counter(map(repr, rows)), Counter(map(repr, expected))
    if left != right:
        problems.append(f"{len(rows)} rows vs {len(expected)}; only spark {list((left - right).items())[:3]}; only sql {list((right - left).items())[:3]}")
    elif not rows:
        problems.append("both sides are empty")
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry_points

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf)
    sqls = entry_points.oracle_sql()
    bad = 0
    for name, query in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = compare(spark, con, name, query, sqls[name], sf)
            else:
                rows = query(spark, sf).count()
                problems = [] if rows else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows only)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{bad} failures")
