"""Runs DuckDB SQL over a folder's tables, or over given frames, and compares rows."""
import duckdb


def duck(sql, sf, **frames):
    con = duckdb.connect()
    for t in "documents pages benchmark labels".split():
        if t not in frames:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for t, df in frames.items():
        con.register(t, df.toArrow())
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def same(df, sql, sf, **frames):
    cols, want = duck(sql, sf, **frames)
    assert sorted(df.columns) == sorted(cols)
    key = lambda r: [str(v) for v in r]
    got = sorted(([r[c] for c in cols] for r in df.collect()), key=key)
    assert got == sorted(([*r] for r in want), key=key)
    return got
