"""Runs a query and its SQL over one folder of tables and gives both as sorted rows of text."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(float(f"{v:.10g}"))
    return str(v)


def both(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    r = con.execute(sql)
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    return mine, sorted(tuple(plain(x[i]) for i in at) for x in r.fetchall())
