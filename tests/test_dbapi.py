"""The DB-API source on SQLite files, an engine inside each task: no server."""

import datetime as dt
import decimal
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringContains

from panelspark.sources import dbapi
from panelspark.sources.extract import extract

COLUMNS = "id long, day date, price decimal(9,2), name string, flag boolean, x double"


@pytest.fixture
def base(tmp_path):
    path = str(tmp_path / "t.db")
    con = sqlite3.connect(path)
    con.execute('CREATE TABLE "trades" (id INTEGER, day TEXT, price REAL, name TEXT COLLATE NOCASE, flag INTEGER, x REAL, unread BLOB)')
    rows = [(i if i % 50 else None, (dt.date(2020, 1, 1) + dt.timedelta(days=i % 90)).isoformat(), i / 4, ["Ann", "ann", None][i % 3],
             i % 2, i / 8, b"z" * 100) for i in range(1000)]
    con.executemany("INSERT INTO trades VALUES (?,?,?,?,?,?,?)", rows)
    con.execute("CREATE TABLE bare (id INTEGER)")
    con.commit()
    con.close()
    return path, rows


def source(spark, path, **options):
    return dbapi.dbapi_source(spark, "sqlite3", {"database": path}, options.pop("columns", COLUMNS), dates="text",
                              **{"table": "trades", **options})


def test_reads_every_row_in_parallel(spark, base):
    path, rows = base
    for options in ({}, {"partition_column": "id"}, {"partition_column": "id", "lower": 100, "upper": 200, "num_partitions": 5}):
        df = source(spark, path, fetchsize=64, **options)
        assert df.rdd.getNumPartitions() == (1 if not options else options.get("num_partitions", 8))
        got = sorted((tuple(r) for r in df.collect()), key=str)
        want = [(i, dt.date.fromisoformat(d), decimal.Decimal(str(p)).quantize(decimal.Decimal("0.01")), n, bool(f), x) for i, d, p, n, f, x, _ in rows]
        assert got == sorted(want, key=str)


def test_filters_reach_the_database(spark, base):
    path, rows = base
    df = source(spark, path, partition_column="id")
    late = dt.date(2020, 3, 1)
    cases = [
        (F.col("day") >= F.lit(late), lambda r: r[1] >= "2020-03-01"),
        (F.col("id").isin(3, 4, 5000), lambda r: r[0] in (3, 4, 5000)),
        (F.col("id").isNull(), lambda r: r[0] is None),
        (F.col("name") == "Ann", lambda r: r[3] == "Ann"),           # the database ignores case, the result does not
        (F.col("name") > "B", lambda r: r[3] is not None and r[3] > "B"),
        ((F.col("x") < 9.5) & (F.col("id") > 20), lambda r: r[5] < 9.5 and r[0] is not None and r[0] > 20),
        (F.col("x") > 100.5, lambda r: r[5] > 100.5),
        (F.col("id").eqNullSafe(F.lit(7)), lambda r: r[0] == 7),
        (F.col("flag") & F.col("name").contains("n"), lambda r: r[4] and r[3] is not None),
    ]
    for cond, keep in cases:
        assert df.filter(cond).count() == sum(1 for r in rows if keep(r)), cond


def test_the_query_holds_columns_and_filters(base):
    path, _ = base
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    reader = dbapi.DbApiReader(schema, {"driver": "sqlite3", "connect": f'{{"database": "{path}"}}', "table": "trades"})
    filters = [GreaterThan(("id",), 990), EqualTo(("name",), "Ann"), StringContains(("name",), "n"), In(("other",), (1,))]
    assert list(reader.pushFilters(filters)) == filters[1:]
    assert reader.where == [('"id" > ?', [990]), ('"name" = ?', ["Ann"])]
    batches = list(reader.read(dbapi.RangePart("", [])))
    assert sum(b.num_rows for b in batches) == 6 and batches[0].schema.names == ["id", "name"]


def test_ranges_hold_every_key_once():
    for lower, upper, parts in ((0, 9, 3), (-5, 5, 4), (7, 7, 8), (0, 1, 8), (5, 3, 4)):
        made = dbapi.ranges("k", lower, upper, parts)
        con = sqlite3.connect(":memory:")
        con.execute("CREATE TABLE t (k INTEGER)")
        con.executemany("INSERT INTO t VALUES (?)", [(None,), *((i,) for i in range(-20, 20))])
        counts = [con.execute("SELECT count(*) FROM t" + (f" WHERE {p.text}" if p.text else ""), p.values).fetchone()[0] for p in made]
        assert sum(counts) == 41 and len(made) <= parts


def test_marks_of_other_drivers():
    text = 'SELECT "a?b%" FROM t WHERE "a" = ? AND "b" > ?'
    assert dbapi.with_marks(text, [1, 2], "pyformat") == ('SELECT "a?b%%" FROM t WHERE "a" = %(p1)s AND "b" > %(p2)s', {"p1": 1, "p2": 2})
    assert dbapi.with_marks("SELECT '?' WHERE a = ?", [1], "named") == ("SELECT '?' WHERE a = :p1", {"p1": 1})
    assert dbapi.with_marks(text, [1, 2], "numeric") == ('SELECT "a?b%" FROM t WHERE "a" = :1 AND "b" > :2', [1, 2])


def test_empty_tables_queries_and_extracts(spark, base, tmp_path):
    path, rows = base
    assert source(spark, path, table="bare", columns="id long", partition_column="id").count() == 0
    q = source(spark, path, table=None, query="SELECT name, count(*) AS n FROM trades GROUP BY name", columns="name string, n long")
    assert sum(r.n for r in q.collect()) == 1000
    with pytest.raises(ValueError):
        source(spark, path, query="SELECT 1")
    out = str(tmp_path / "trades.parquet")
    assert extract(source(spark, path, partition_column="id"), out) == 1000
    back = spark.read.parquet(out)
    assert dict(back.dtypes)["price"] == "double" and back.agg(F.sum("price")).first()[0] == sum(r[2] for r in rows)
