"""SQL table targets: created once from learned columns, first write per time wins."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.constants import NUMBER_SCALE, TIME_FIELD
from tagstream.functions.plan import quoted
from tagstream.operators.keyed import first_write_wins, insert_ignore
from tagstream.sinks.batch_store import BATCH, BatchStore

DAY = 86_400
VERSION_TYPE = "STRUCT<timestamp: TIMESTAMP, partition: INT, offset: BIGINT>"


def tags_of(schema: T.StructType, keys: tuple[str, ...] = ()) -> list[str]:
    """The table's columns but for the time and further keys, wherever these stand."""
    return [f.name for f in schema.fields if f.name != TIME_FIELD and f.name not in keys]


class ParquetTable:
    """A table as a Parquet folder, partitioned by day of the time.

    Rows come as ``conform`` makes them, reduced to one per key (the time and ``key_columns``).
    ``keep="event"`` shows the earliest message per key whatever the arrival order: batches are
    appended as they are, and a reader keeps the earliest. ``keep="arrival"`` never
    stores a second row of a key, like a primary key: a batch is held against the stored rows
    of its days.
    """

    def __init__(
        self, spark: SparkSession, root: str, keep: str = "event", key_columns: dict[str, str] | None = None
    ):
        if keep not in ("event", "arrival"):
            raise ValueError("keep must be 'event' or 'arrival'")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.key_columns = dict(key_columns or {})
        self.keys = [TIME_FIELD, *self.key_columns]
        self._schema: T.StructType | None = None

    def schema(self) -> T.StructType | None:
        """The table's columns, None while it does not exist."""
        if self._schema is None:
            try:
                self._schema = self.spark.read.parquet(f"{self.root}/schema").schema
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return self._schema

    def create(self, schema: T.StructType) -> None:
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/schema")
        self._schema = None

    @property
    def looks_up(self) -> bool:
        """Whether ``insert_new`` reads stored rows, and so needs the days."""
        return self.keep == "arrival"

    def insert_new(self, rows: DataFrame, batch_id: int, days: list[int] | None = None) -> None:
        """Append rows whose key is not stored yet; ``days`` are those the rows cover (None: any).

        Only the folders of these days are read, so one reading with a time far off does not
        pull in the days between. The batch's own rows are left out, so a replay writes the same
        rows again.
        """
        if self.looks_up and days == []:
            return
        if self.looks_up:
            others = self._store().read(days).filter(F.col(BATCH) != batch_id)
            rows = insert_ignore(rows, others, self.keys)
        self.append(rows, batch_id)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch of rows as they are, a file for a day's few rows."""
        self._store().write(rows.withColumn("day", day_of(F.col(TIME_FIELD))), batch_id)

    def view(self) -> DataFrame:
        schema = self.schema()
        if schema is None:
            raise LookupError(f"no table at {self.root} yet: no usable reading has come")
        rows = self._store().read().drop(BATCH, "day")
        first = first_write_wins(rows, self.keys, F.col("ver"))
        own = set(self.keys)
        return first.selectExpr(*[quoted(f.name) if f.name in own else f"tags.{quoted(f.name)}" for f in schema.fields])

    def copied(self, root: str) -> "ParquetTable":
        """The table at ``root`` with one row per key, in one batch."""
        copy = ParquetTable(self.spark, root, self.keep, self.key_columns)
        copy.create(self.schema())
        keys = [*self.keys, "day"]
        self._store().copied(f"{copy.root}/data", lambda rows: first_write_wins(rows, keys, F.col("ver")))
        return copy

    def _store(self) -> BatchStore:
        fields = {f.name: f.dataType.simpleString() for f in self.schema().fields}
        tags = [f"{quoted(t)}: {fields[t]}" for t in tags_of(self.schema(), tuple(self.keys))]
        data = [f"{TIME_FIELD} BIGINT", *[f"{quoted(c)} {t}" for c, t in self.key_columns.items()], f"ver {VERSION_TYPE}"]
        if tags:
            data.append(f"tags STRUCT<{', '.join(tags)}>")
        return BatchStore(self.spark, f"{self.root}/data", ", ".join(data), {"day": "BIGINT"})


def day_of(time: Column) -> Column:
    return F.floor(time / DAY)


@dataclass
class JdbcTable:
    """A table behind JDBC. ``options`` holds url, driver class, user and password.

    A primary key on ``time`` in the database guards against other writers; the
    statement of ``create_statement`` declares it. A batch that fails half way
    replays safely, because rows that landed are not inserted again.
    """

    spark: SparkSession
    table: str
    options: dict[str, str] = field(repr=False)
    database: str | None = None
    catalog_view: str = "information_schema.tables"
    batch_rows: int = 5000
    parallelism: int = 8
    key_columns: dict[str, str] = field(default_factory=dict)
    identifier_quote: str = "`"

    def schema(self) -> T.StructType | None:
        found = self._reader(self.catalog_view).filter(F.col("table_name") == self.table)
        if self.database:
            found = found.filter(F.col("table_schema") == self.database)
        if found.isEmpty():
            return None
        stored = self._reader(self.table).schema
        return T.StructType(
            [T.StructField(tag_name(f.name), f.dataType, f.nullable) for f in stored.fields]
        )

    def create(self, schema: T.StructType) -> None:
        jvm = self.spark._jvm
        properties = jvm.java.util.Properties()
        for name in ("user", "password"):
            if name in self.options:
                properties.setProperty(name, self.options[name])
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        driver = jvm.java.lang.Class.forName(self.options["driver"], True, loader).newInstance()
        connection = driver.connect(self.options["url"], properties)
        try:
            connection.createStatement().executeUpdate(
                create_statement(self.table, schema, self.keys, self.identifier_quote)
            )
        finally:
            connection.close()

    looks_up = True

    def insert_new(self, rows: DataFrame, batch_id: int, days: list[int] | None = None) -> None:
        if days == []:
            return
        wide = rows.select(*[quoted(k) for k in self.keys], *(["tags.*"] if "tags" in rows.columns else []))
        named = wide.select([F.col(quoted(c)).alias(column_name(c)) for c in wide.columns])
        new = insert_ignore(named, self._stored_keys(days), [column_name(k) for k in self.keys])
        new.write.format("jdbc").mode("append").options(
            **self.options,
            dbtable=self.table,
            batchsize=str(self.batch_rows),
            numPartitions=str(self.parallelism),
        ).save()

    @property
    def keys(self) -> list[str]:
        return [TIME_FIELD, *self.key_columns]

    def day_predicates(self, days: list[int]) -> list[str]:
        """Conditions that cover these days and no other, one per connection, ``parallelism`` at most.

        Days that follow each other are one range, and the ranges are dealt to the conditions.
        """
        time = self.quote(column_name(TIME_FIELD))
        ranges: list[list[int]] = []
        for day in sorted(set(days)):
            if ranges and ranges[-1][1] == day:
                ranges[-1][1] = day + 1
            else:
                ranges.append([day, day + 1])
        if len(ranges) < self.parallelism:
            ranges = _split(ranges, self.parallelism)
        texts = [f"{time} >= {a * DAY} AND {time} < {b * DAY}" for a, b in ranges]
        dealt = [texts[i :: self.parallelism] for i in range(min(self.parallelism, len(texts)))]
        return [own[0] if len(own) == 1 else " OR ".join(f"({t})" for t in own) for own in dealt]

    def _stored_keys(self, days: list[int] | None) -> DataFrame:
        if days is None:
            return self._reader(self.table).select(*[column_name(k) for k in self.keys])
        names = [column_name(k) for k in self.keys]
        properties = {k: v for k, v in self.options.items() if k != "url"}
        found = self.spark.read.jdbc(
            self.options["url"], self.table, predicates=self.day_predicates(days), properties=properties
        )
        return found.select(*names)

    def quote(self, name: str) -> str:
        return f"{self.identifier_quote}{name}{self.identifier_quote}"

    def _reader(self, table: str, **extra: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options, dbtable=table, **extra).load()


def _split(ranges: list[list[int]], most: int) -> list[list[int]]:
    """The longest ranges of days halved, until there are ``most`` ranges or each is one day."""
    ranges = [list(r) for r in ranges]
    while len(ranges) < most:
        longest = max(range(len(ranges)), key=lambda i: ranges[i][1] - ranges[i][0], default=None)
        if longest is None or ranges[longest][1] - ranges[longest][0] == 1:
            break
        a, b = ranges[longest]
        ranges[longest : longest + 1] = [[a, (a + b) // 2], [(a + b) // 2, b]]
    return ranges


def column_name(tag: str) -> str:
    """A tag as a word of letters, digits and underscores; ``tag_name`` reverses it.

    The empty tag and one that starts with a digit get a prefix, so that every name is one
    that databases accept once it is quoted.
    """
    name = re.sub(r"[^A-Za-z0-9_]|_(?=x)", lambda m: f"_x{ord(m.group()):X}_", tag)
    return f"_x_{name}" if not name or name[0].isdigit() else name


def tag_name(column: str) -> str:
    return re.sub(r"_x([0-9A-F]+)_", lambda m: chr(int(m.group(1), 16)), column.removeprefix("_x_"))


def create_statement(
    table: str, schema: T.StructType, keys: list[str] | None = None, quote: str = "`"
) -> str:
    """CREATE TABLE for the learned columns, every column name quoted (it may be a reserved word)."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", table):
        raise ValueError(f"not a plain table name: {table!r}")
    keys = keys or [TIME_FIELD]
    types = {T.LongType(): "BIGINT", T.IntegerType(): "INT", T.StringType(): "VARCHAR(255)"}
    columns = [
        f"{quote}{column_name(f.name)}{quote} "
        + (f"{types[f.dataType]} NOT NULL" if f.name in keys else f"DOUBLE(10,{NUMBER_SCALE})")
        for f in schema.fields
    ]
    primary = ", ".join(f"{quote}{column_name(k)}{quote}" for k in keys)
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, PRIMARY KEY ({primary}))"
