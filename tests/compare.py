"""Run a query and its SQL on the same tables and compare them as multisets."""

from collections import Counter
from pathlib import Path

import duckdb

# DuckDB types as the DataFrame types they must meet.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date",
}


def connect(sf_dir):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(con, df, sql):
    """Differences between both results; empty when they agree."""
    described = con.execute("DESCRIBE " + sql).fetchall()
    oracle = {r[0]: TYPES.get(r[1], r[1]) for r in described}
    ours = dict(df.dtypes)
    if oracle != ours:
        odd = {k: (ours.get(k), oracle.get(k)) for k in set(ours) | set(oracle)
               if ours.get(k) != oracle.get(k)}
        return [f"columns differ (ours, sql): {odd}"]
    names = sorted(ours)
    expected = con.execute(sql).fetchall()
    order = [list(oracle).index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected)
    have = Counter(tuple(row[n] for n in names) for row in df.collect())
    problems = []
    if sum(want.values()) != sum(have.values()):
        problems.append(f"rows: ours {sum(have.values())}, sql {sum(want.values())}")
    extra, missing = have - want, want - have
    if extra:
        problems.append(f"only ours ({sum(extra.values())}): {list(extra)[:3]}")
    if missing:
        problems.append(f"only sql ({sum(missing.values())}): {list(missing)[:3]}")
    return problems
