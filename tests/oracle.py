"""Compare a query with its oracle: columns, types by family, rows as multisets."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _family(type_name: str) -> str:
    name = type_name.lower().split("(")[0]
    return {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}.get(name, name)


def _plain(value):
    if isinstance(value, float):
        return "NaN" if value != value else value
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(con, df, sql: str) -> list[str]:
    """Differences, none when the two agree."""
    theirs = con.execute(sql)
    their_types = {d[0]: _family(str(d[1])) for d in theirs.description}
    their_rows = theirs.fetchall()
    our_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    if sorted(our_types) != sorted(their_types):
        return [f"columns {sorted(our_types)} against {sorted(their_types)}"]
    described = {row[0]: _family(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in our_types.items():
        if described[name] != kind:
            problems.append(f"type of {name}: {kind} against {described[name]}")
    names = sorted(our_types)
    order = [list(their_types).index(n) for n in names]
    expected = Counter(tuple(_plain(r[i]) for i in order) for r in their_rows)
    actual = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if expected != actual:
        problems.append(
            f"rows {sum(actual.values())} against {sum(expected.values())}; only ours "
            f"{list((actual - expected).items())[:3]}; only theirs {list((expected - actual).items())[:3]}"
        )
    return problems
