"""Compare a registered query with its SQL twin, as the driver does."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None or value != value:
        return "~"
    if isinstance(value, (bool, int, str)):
        return str(value)
    try:
        return f"{float(value):.6f}"
    except (TypeError, ValueError):
        return str(value)


def differences(df, relation):
    """Columns that differ, or rows of either side that the other lacks."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [names, sorted(relation.columns)]
    places = [relation.columns.index(n) for n in names]
    ours = sorted(tuple(map(canonical, r)) for r in df.select(*names).collect())
    theirs = sorted(tuple(canonical(r[i]) for i in places) for r in relation.fetchall())
    return [] if ours == theirs else [sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3], len(ours), len(theirs)]
