"""Rows of a query and of its SQL, made comparable."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def normal(found):
    """Whole numbers that one engine gives as doubles are equal to its longs."""
    return [tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in r) for r in found]
