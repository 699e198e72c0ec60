"""Compare a query's rows with those of its SQL.

    python tests/compare.py sf0.01 [name ...]
"""

import datetime
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    """A value in a form both engines share; floats keep every digit."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return float(v) if v % 1 else int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, ordered(df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(r[i] for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], ordered(rows)


def difference(got, want):
    """None, or a text that says what differs."""
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    for a, b in zip(got[1], want[1], strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None


def main(scale, names):
    import __spark_entry__ as entry

    from plumbline.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    sf = f"/root/testdata/{scale}"
    con = duck(sf)
    runs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or runs:
        started = time.time()
        try:
            got = spark_rows(runs[name](spark, sf))
            took = time.time() - started
            if name in sqls:
                note = difference(got, duck_rows(con, sqls[name]))
            else:
                note = None if got[1] else "no rows"
            status = "ok" if note is None else "DIFF"
            print(f"{status:5}{name:28}{len(got[1]):8} rows {took:6.1f}s {time.time()-started-took:5.1f}s", note or "", flush=True)
        except Exception as e:  # noqa: BLE001
            note = str(e)[:600]
            print(f"FAIL {name:28} {type(e).__name__}: {note}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += note is not None
    print(f"{bad} bad of {len(names or runs)}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
