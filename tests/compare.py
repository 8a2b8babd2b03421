"""Compare registered queries with their SQL counterparts."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from tallyscope.plans import views


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in views.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (float, int)):
        return float(v) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def coarse(v):
    """A value for sorting: numbers to few digits, so that both sides of nearly equal rows sort alike."""
    return f"{v:.4g}" if isinstance(v, float) else repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(found, key=lambda r: (*map(coarse, r), repr(r))), [columns[i] for i in order]


def same(x, y):
    """Equal values; numbers up to the last digits, which depend on the order of summation."""
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-11)
    return x == y


def unmatched(a, b):
    """Rows without a partner on the other side; near ties may have been sorted differently, so leftovers are searched."""
    left = [(x, y) for x, y in zip(a, b) if not all(map(same, x, y))]
    rest = [y for _, y in left]
    alone = []
    for x, _ in left:
        partner = next((k for k, y in enumerate(rest) if all(map(same, x, y))), None)
        if partner is None:
            alone.append(x)
        else:
            rest.pop(partner)
        if len(alone) > 20:
            break
    return list(zip(alone, rest))


KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder, name, fn, sql):
    """Return a list of problems (empty when both agree), and the times."""
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    mid = time.time()
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    kinds = {c[0]: str(c[1]) for c in rel.description}
    want = rel.fetchall()
    end = time.time()
    problems = []
    a, ca = rows_of(df.columns, got)
    b, cb = rows_of(cols, want)
    if ca != cb:
        problems.append(f"columns {ca} / {cb}")
    types = {c: KIND.get(k, k) for c, k in df.dtypes}
    odd = {c: (types[c], kinds[c]) for c in types if c in kinds and types[c] != kinds[c]}
    if odd:
        problems.append(f"types {odd}")
    if len(a) != len(b):
        problems.append(f"rows {len(a)} / {len(b)}")
    elif ca == cb and (bad := unmatched(a, b)):
        problems.append(f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:2]}")
    if not a:
        problems.append("no rows")
    return problems, len(a), mid - start, end - mid


def main(folder="/root/testdata/sf0.01", *only):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from tests.session import local_session

    spark = local_session()
    con = connect(folder)
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name in only or q:
        if name not in o:
            start = time.time()
            try:
                print(f"{name:28} rows-only {len(q[name](spark, folder).collect())} {time.time() - start:.1f}s", flush=True)
            except Exception as x:  # noqa: BLE001
                bad += 1
                print(f"{name:28} FAIL {str(x)[:700]}", flush=True)
            continue
        try:
            problems, n, ts, td = compare(spark, con, folder, name, q[name], o[name])
        except Exception as x:  # noqa: BLE001
            problems, n, ts, td = [f"{type(x).__name__}: {str(x)[:900]}"], -1, 0, 0
        bad += bool(problems)
        print(f"{name:28} {'ok  ' if not problems else 'FAIL'} rows={n} spark={ts:.1f}s duck={td:.1f}s {problems or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
