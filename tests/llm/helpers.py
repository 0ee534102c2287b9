"""Small tables and brute-force versions that the tests share."""

from __future__ import annotations

import re

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def real_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def clashing(df, *names):
    """``df`` with extra columns of names that the operators use themselves."""
    for name in names:
        if name not in df.columns:
            df = df.withColumn(name, df[df.columns[0]].cast("string"))
    return df


def rows_of(df, *cols):
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def oracle(sql, *tables, sf=SF):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con.execute(sql).fetchall()


def oracle_frame(sql, *tables, sf=SF, files=""):
    """The result of ``sql`` with its columns; ``files`` follows the path of tables that are folders."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet{files}'")
    return con.sql(sql)


def components(n, linked):
    """The smallest reachable index of each of ``n`` nodes; ``linked(i, j)`` tells links."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
