"""SQL databases through their Python drivers (DB-API 2.0), for clusters without a JDBC driver jar
(S1, S2, S14).

A Spark data source in Python: the table (or query) is read by parallel range queries, each inside
its own task; the columns asked for and the filters that mean the same in the database and in Spark
become part of the query text and its parameters. Rows leave a task as Arrow batches of one fetch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual)

from panelspark.session import ship_package
from panelspark.sources.extract import batch_rows

_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
FETCH_MB = 64


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def condition(f, known: set[str]) -> tuple[str, list, bool] | None:
    """(text with ? marks, parameters, exact) of a filter; None where the database could drop a row
    that Spark keeps. Equality of texts is sent but not exact: collations may ignore case, so Spark
    checks it again; the order of texts depends on the collation and is left to Spark."""
    if len(f.attribute) != 1 or f.attribute[0] not in known:
        return None
    col = quoted(f.attribute[0])
    if isinstance(f, IsNull):
        return f"{col} IS NULL", [], True
    if isinstance(f, IsNotNull):
        return f"{col} IS NOT NULL", [], True
    plain = (bool, int, decimal.Decimal, dt.date)
    if isinstance(f, In):
        values = [v for v in f.value if v is not None]  # a NULL in the list never matches
        if not values or not all(isinstance(v, (*plain, str)) for v in values):
            return None
        return f"{col} IN ({', '.join('?' * len(values))})", values, all(isinstance(v, plain) for v in values)
    value = getattr(f, "value", None)
    if isinstance(f, EqualNullSafe) and value is None:
        return f"{col} IS NULL", [], True
    sign = "=" if isinstance(f, EqualNullSafe) else _COMPARE.get(type(f))
    if sign is None or value is None:
        return None
    if isinstance(value, str):
        return (f"{col} = ?", [value], False) if sign == "=" else None
    if isinstance(value, float):
        # databases differ on NaN, which Spark sorts above all numbers: let it through, Spark decides
        if value != value or sign in (">", ">="):
            return None
        return f"{col} {sign} ?", [value], False
    return (f"{col} {sign} ?", [value], True) if isinstance(value, plain) else None


def with_marks(text: str, values: list, style: str):
    """The query text and parameters in the driver's own ``paramstyle``; question marks inside quoted
    names and texts stay."""
    if style == "qmark":
        return text, values
    out, n, quote = [], 0, ""
    for ch in text:
        if ch == quote:
            quote = ""
        elif not quote and ch in "'\"":
            quote = ch
        if ch == "?" and not quote:
            n += 1
            out.append({"numeric": f":{n}", "named": f":p{n}", "format": "%s", "pyformat": f"%(p{n})s"}[style])
        else:
            out.append("%%" if ch == "%" and style in ("format", "pyformat") else ch)
    named = style in ("named", "pyformat")
    return "".join(out), {f"p{i + 1}": v for i, v in enumerate(values)} if named else values


class RangePart(InputPartition):
    """One range query: lower <= column < upper; the first also holds NULL and smaller, the last larger keys."""

    def __init__(self, text: str, values: list):
        self.text, self.values = text, values


def ranges(column: str | None, lower: int, upper: int, parts: int) -> list[RangePart]:
    """Disjoint conditions that together hold every row."""
    parts = min(parts, max(upper - lower + 1, 1))
    if column is None or parts < 2:
        return [RangePart("", [])]
    col = quoted(column)
    cuts = [lower + (upper - lower + 1) * i // parts for i in range(1, parts)]
    out = [RangePart(f"({col} < ? OR {col} IS NULL)", [cuts[0]])]
    out += [RangePart(f"({col} >= ? AND {col} < ?)", [a, b]) for a, b in zip(cuts, cuts[1:])]
    return [*out, RangePart(f"{col} >= ?", [cuts[-1]])]


def to_type(value, kind: T.DataType):
    """A driver's value as Arrow takes it for the column (text dates and numbers, whole-number flags)."""
    if value is None:
        return None
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(value[:10]) if isinstance(value, str) else value.date() if isinstance(value, dt.datetime) else value
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    if isinstance(kind, T.DecimalType):
        number = value if isinstance(value, decimal.Decimal) else decimal.Decimal(str(value))
        return number.quantize(decimal.Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.BooleanType):
        return bool(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(value)
    return value


class DbApiReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = schema
        self.options = {k.lower(): v for k, v in options.items()}
        self.where: list[tuple[str, list]] = []

    def option(self, name: str, default=None):
        return self.options.get(name.lower(), default)

    def pushFilters(self, filters):
        for f in filters:
            made = condition(f, set(self.columns.names))
            if made is not None:
                self.where.append(made[:2])
            if made is None or not made[2]:
                yield f

    def _run(self, select: str, extra: list[tuple[str, list]]):
        """(connection, cursor) of an executed query over the table or query and all conditions."""
        driver = importlib.import_module(self.option("driver"))
        source = quoted(self.option("table")) if self.option("table") else f"({self.option('query')}) AS q"
        conds = [c for c in (*self.where, *extra) if c[0]]
        text = f"SELECT {select} FROM {source}" + (" WHERE " + " AND ".join(c[0] for c in conds) if conds else "")
        values = [v for c in conds for v in c[1]]
        if self.option("dates") == "text":
            values = [v.isoformat() if isinstance(v, dt.date) else v for v in values]
        text, values = with_marks(text, values, driver.paramstyle)
        connection = driver.connect(**json.loads(self.option("connect", "{}")))
        cursor = connection.cursor()
        cursor.execute(text, values)
        return connection, cursor

    def partitions(self):
        column, parts = self.option("partitionColumn"), int(self.option("numPartitions", 8))
        lower, upper = self.option("lowerBound"), self.option("upperBound")
        if column is not None and (lower is None or upper is None):
            connection, cursor = self._run(f"min({quoted(column)}), max({quoted(column)})", [])
            low, high = cursor.fetchone()
            connection.close()
            lower, upper = (0, 0) if low is None else (low, high)
        return ranges(column, int(lower or 0), int(upper or 0), parts)

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [f.dataType for f in self.columns.fields]
        arrow = to_arrow_schema(self.columns)
        size = int(self.option("fetchsize") or batch_rows(len(kinds), FETCH_MB))
        connection, cursor = self._run(", ".join(quoted(c) for c in self.columns.names), [(partition.text, partition.values)])
        try:
            while rows := cursor.fetchmany(size):
                yield pa.RecordBatch.from_arrays([pa.array([to_type(r[i], k) for r in rows], type=arrow.field(i).type)
                                                  for i, k in enumerate(kinds)], schema=arrow)
        finally:
            connection.close()


class DbApiSource(DataSource):
    @classmethod
    def name(cls):
        return "dbapi"

    def reader(self, schema):
        return DbApiReader(schema, dict(self.options))


def dbapi_source(spark: SparkSession, driver: str, connect: dict, columns: str, table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
                 fetchsize: int | None = None, dates: str = "native") -> DataFrame:
    """A table or query of a database as a DataFrame, read when it is used.

    ``driver`` is the module of a DB-API driver that every executor can import, ``connect`` the arguments
    of its ``connect`` (a database that all executors reach). ``columns`` names the columns read with
    their Spark types ("id long, day date"); no others are fetched. ``partition_column`` (whole numbers)
    splits the read into ``num_partitions`` queries; without ``lower`` and ``upper`` one query asks for
    its bounds, under the pushed filters. NULL keys and keys beyond the bounds are read as well. ``fetchsize``
    defaults to the batch rule for 64 MB. ``dates="text"`` sends dates as ISO text, for databases that
    keep them so; naive times are UTC. An empty table gives no rows. Turns on Spark's filter pushdown for
    Python sources in the session.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DbApiSource)
    options = {"driver": driver, "connect": json.dumps(connect), "table": table, "query": query, "partitionColumn": partition_column,
               "lowerBound": lower, "upperBound": upper, "numPartitions": num_partitions, "fetchsize": fetchsize, "dates": dates}
    return spark.read.format("dbapi").schema(columns).options(**{k: str(v) for k, v in options.items() if v is not None}).load()
