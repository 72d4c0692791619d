import json
import re
from datetime import timedelta

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.operators.keyed import first_write_wins
from tagstream.operators.messages import parse_readings, usable
from tagstream.operators.tableschema import (
    conform,
    infer_table_columns,
    rejected_tags,
    table_schema,
    tag_types,
)
from tagstream.sinks.table import (
    JdbcTable,
    DAY,
    ParquetTable,
    column_name,
    create_statement,
    tag_name,
    tags_of,
)
from tests.messages import START, bodies

TIME = '"time":"2017-08-01 10:00:00"'


def readings(spark, *values):
    return usable(parse_readings(bodies(spark, *values)))


def columns(spark, mode, *values):
    rows = infer_table_columns(readings(spark, *values), mode).collect()
    return {r.column_name: r.column_type for r in rows}


def test_first_reading_or_union_decides(spark):
    log = ("ping", '{"b.c":1,%s}' % TIME, '{"a":"x","l":[1],%s}' % TIME)
    assert columns(spark, "first", *log) == {"time": "bigint", "b.c": "double"}
    assert columns(spark, "union", *log) == {"time": "bigint", "a": "double", "b.c": "double", "l": "double"}
    with pytest.raises(ValueError):
        columns(spark, "last", *log)


def test_names_equal_but_for_case(spark):
    log = ('{"TIME":1,"b":1,%s}' % TIME, '{"B":1,%s}' % TIME)
    assert columns(spark, "union", *log) == {"time": "bigint", "B": "double"}


HELPERS = ["_day", "_kind", "_batch_id", "ver", "day", "tags", "n_rejected", "n_tags", "body", "batch_time", "stored", "alive"]


def test_types_of_all_tags(spark):
    odd = readings(
        spark, '{"time": "2024-01-01 00:00:00", "a.b": 1, "O<B>: X,": {"OBJECT<": 2}, "q`r": null, "": true}',
        '{"time": "2024-01-01 00:00:01", "a.b": "text", "A.B": 1.5, "l": [1, "x"], "\u00e9 `c` d": "t"}',
    )
    assert tag_types(odd) == {
        "time": "string", "a.b": "variant", "O<B>: X,": "struct<OBJECT<:bigint>", "q`r": "void", "": "boolean",
        "A.B": "decimal(2,1)", "l": "array<variant>", "\u00e9 `c` d": "string",
    }
    assert tag_types(odd.limit(0)) == {}
    names = [r.column_name for r in infer_table_columns(odd, "union").collect()]
    assert sorted(names) == sorted(["time", "A.B", "O<B>: X,", "q`r", "", "l", "\u00e9 `c` d"])


def test_five_thousand_tags(spark):
    """Dealt over readings of a hundred each, names that differ in case among them."""
    time = '"time": "2024-01-01 00:00:00"'
    own = [f"Tag.{i}" for i in range(5000)] + [f"tAG.{i}" for i in range(0, 5000, 50)]
    bodies = ["{" + ", ".join([time, *[f'"{t}": {i}' for t in own[i : i + 100]]]) + "}" for i in range(0, len(own), 100)]
    log = readings(spark, *bodies).repartition(5)
    got = {r.column_name: r.column_type for r in infer_table_columns(log, "union").collect()}
    assert got == {f"Tag.{i}": "double" for i in range(5000)} | {"time": "bigint"}
    plan = log.agg(F.schema_of_variant_agg("body"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_schema_of_variant_agg" in plan


def test_tags_called_like_our_own_columns(spark, tmp_path):
    body = json.dumps({"time": "2017-08-01 10:00:00", **{t: i for i, t in enumerate(HELPERS)}})
    log = readings(spark, body)
    schema = table_schema(infer_table_columns(log))
    assert {f.name for f in schema.fields} == {"time", *HELPERS}
    table = ParquetTable(spark, str(tmp_path / "t"))
    table.create(schema)
    rows = first_write_wins(conform(log, tags_of(schema)).drop("n_rejected"), ["time"], F.col("ver"))
    table.insert_new(rows, 0, [1501581600 // DAY])
    row = table.view().first()
    assert [row[t] for t in HELPERS] == list(range(len(HELPERS)))


def test_more_columns_than_ten_thousand(spark):
    names = spark.range(10_500).select(F.concat(F.lit("t"), F.col("id")).alias("column_name"), F.lit("double").alias("column_type"))
    assert len(table_schema(names).fields) == 10_501


def test_schema_order_and_absence(spark):
    schema = table_schema(infer_table_columns(readings(spark, '{"z":1,"a":1,%s}' % TIME)))
    assert schema.simpleString() == "struct<time:bigint,a:double,z:double>"
    assert not schema["time"].nullable
    assert table_schema(infer_table_columns(readings(spark, "ping"))) is None


MIXED = '{%s,"a":"12.5","b":"x","c":true,"d":null,"e":[1],"f":12345678.9,"g":"NaN","t.u":1,"B":2}' % TIME


def test_conform(spark):
    rows = conform(readings(spark, MIXED), ["a", "b", "c", "d", "e", "f", "g", "h"])
    row = rows.first().asDict(recursive=True)
    row.pop("ver")
    assert row == {
        "time": 1501581600, "n_rejected": 5, "tags": {
            "a": 12.5, "b": None, "c": 1.0, "d": None, "e": None, "f": 9999999.999, "g": None, "h": None},
    }
    assert conform(readings(spark, MIXED), []).first()["n_rejected"] == 8


def test_rejected_tags(spark):
    rows = rejected_tags(readings(spark, MIXED), ["a", "b", "c", "d", "e", "f", "g", "h"]).collect()
    assert {(r.tag, r.value, r.reason) for r in rows} == {
        ("b", '"x"', "non_numeric"), ("e", "[1]", "non_numeric"), ("g", '"NaN"', "non_numeric"),
        ("t.u", "1", "unknown_column"), ("B", "2", "unknown_column"),
    }


def test_any_tag_as_a_column(spark):
    tags = ["it's", "back\\slash", "tick`s", 'say "hi"', "标签", "a b", "_body2", "offset"]
    body = json.dumps({"time": "2017-08-01 10:00:00", **{t: i for i, t in enumerate(tags)}, "more": 1})
    row = conform(readings(spark, body), tags).first()
    assert [row["tags"][t] for t in tags] == list(range(len(tags))) and row["n_rejected"] == 1
    assert [r.tag for r in rejected_tags(readings(spark, body), tags).collect()] == ["more"]


def test_conform_failfast(spark):
    good = '{%s,"a":1}' % TIME
    assert conform(readings(spark, good), ["a"], "FAILFAST").count() == 1
    with pytest.raises(PySparkException, match="tag without a numeric column: 0 1"):
        conform(readings(spark, good, '{%s,"b":1}' % TIME), ["a"], "FAILFAST").collect()


def test_a_thousand_tags(spark):
    names = [f"T{i}.AV" for i in range(1000)]
    body = "{%s,%s}" % (TIME, ",".join(f'"{n}":{i}' for i, n in enumerate(names)))
    row = conform(readings(spark, body, body), names).first()
    assert [row["tags"][n] for n in names] == [float(i) for i in range(1000)] and row["n_rejected"] == 0


SCHEMA = T.StructType([T.StructField("time", T.LongType(), False), T.StructField("v.a", T.DoubleType())])


def rows(spark, *data):
    """(time, value, version)"""
    return spark.createDataFrame(
        [((START + timedelta(seconds=ver), 0, ver), time, (value,)) for time, value, ver in data],
        "ver struct<timestamp: timestamp, partition: int, offset: bigint>, time bigint, tags struct<`v.a`: double>",
    )


def put(table, batch_id, *data):
    table.insert_new(rows(table.spark, *data), batch_id, sorted({time // DAY for time, _, _ in data}))


@pytest.fixture(params=["event", "arrival"])
def table(request, spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), keep=request.param)
    assert table.schema() is None
    table.create(SCHEMA)
    table.create(T.StructType([T.StructField("time", T.LongType())]))
    assert [f.name for f in ParquetTable(spark, table.root).schema()] == ["time", "v.a"]
    return table


def content(table):
    return {r["time"]: r["v.a"] for r in table.view().collect()}


def test_first_write_wins_across_batches_and_days(spark, table):
    put(table, 0, (1, 1.0, 10), (DAY - 1, 2.0, 11), (-5, 9.0, 12))
    put(table, 1, (1, 5.0, 20), (DAY - 1, 6.0, 3), (DAY, 7.0, 22), (9 * DAY, 8.0, 23))
    late = 6.0 if table.keep == "event" else 2.0
    want = {-5: 9.0, 1: 1.0, DAY - 1: late, DAY: 7.0, 9 * DAY: 8.0}
    assert content(table) == want
    put(table, 1, (1, 5.0, 20), (DAY - 1, 6.0, 3), (DAY, 7.0, 22), (9 * DAY, 8.0, 23))
    assert content(table) == want
    put(table, 2, (1, 4.0, 99), (2, 3.0, 98))
    want[2] = 3.0
    assert content(table) == want
    copy = table.copied(f"{table.root}-copy")
    assert content(copy) == want and copy._store().read().count() == len(want)
    put(copy, 2, (1, 4.0, 99), (2, 3.0, 98))
    assert content(copy) == want


def test_empty_batch(spark, table):
    table.insert_new(rows(spark, (1, 1.0, 1)).limit(0), 0, [])
    assert content(table) == {}


def test_a_table_that_does_not_exist_yet(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "none"))
    with pytest.raises(LookupError):
        table.view()


def test_only_the_days_of_the_batch_are_listed(spark, table):
    put(table, 0, *[(d * DAY, 1.0, d) for d in range(9)])
    some = table._store().read([3, 7, 50])
    files = {r.f for r in some.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) == 2 and all("day=3/" in f or "day=7/" in f for f in files)
    assert "PartitionFilters: [day" in some._jdf.queryExecution().executedPlan().toString()
    assert table._store().read([50]).count() == 0
    assert table._store().read().count() == 9


def test_a_batch_over_1500_days(spark, table):
    put(table, 0, *[(d * DAY, 1.0, d) for d in range(0, 1800, 300)])
    data = [(d * DAY + s, 2.0, 5000 + d) for d in range(1500) for s in (0, 1)]
    put(table, 1, *data)
    got = content(table)
    assert len(got) == 3001
    assert all(got[d * DAY] == (1.0 if d % 300 == 0 else 2.0) for d in range(1500))


def test_further_keys(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), key_columns={"device": "string"})
    table.create(T.StructType([*SCHEMA.fields, T.StructField("device", T.StringType())]))
    two = rows(spark, (1, 1.0, 1), (1, 2.0, 2)).withColumn("device", F.concat(F.lit("d"), F.col("ver.offset")))
    table.insert_new(two, 0, [0])
    table.insert_new(two.withColumn("ver", F.col("ver").withField("offset", F.lit(9))), 1, [0])
    assert table.view().columns == ["time", "v.a", "device"]
    assert sorted(map(tuple, table.view().collect())) == [(1, 1.0, "d1"), (1, 2.0, "d2")]


@given(st.text(max_size=20))
def test_column_names_are_plain_and_reversible(tag):
    assert re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", column_name(tag))
    assert tag_name(column_name(tag)) == tag


def test_create_statement():
    assert create_statement("test_4cols", SCHEMA) == (
        "CREATE TABLE IF NOT EXISTS test_4cols "
        "(`time` BIGINT NOT NULL, `v_x2E_a` DOUBLE(10,3), PRIMARY KEY (`time`))"
    )
    odd = T.StructType([T.StructField(n, T.DoubleType()) for n in ("order", "1", "")] + [SCHEMA.fields[0]])
    assert create_statement("t", odd, quote='"') == (
        'CREATE TABLE IF NOT EXISTS t ("order" DOUBLE(10,3), "_x_1" DOUBLE(10,3), "_x_" DOUBLE(10,3), '
        '"time" BIGINT NOT NULL, PRIMARY KEY ("time"))'
    )
    keyed = T.StructType([SCHEMA.fields[0], T.StructField("device", T.StringType())])
    assert create_statement("t", keyed, ["time", "device"]).endswith("PRIMARY KEY (`time`, `device`))")
    with pytest.raises(ValueError):
        create_statement("t; drop table x", SCHEMA)


def test_jdbc_reads_the_days_of_the_batch_only(spark):
    table = JdbcTable(spark, "t", {"url": "jdbc:x"})
    assert table.day_predicates([9, 0]) == [
        "`time` >= 0 AND `time` < 86400", "`time` >= 777600 AND `time` < 864000"]


@pytest.mark.parametrize("days", [[5], [3, 4, 5], list(range(40)), [*range(100, 103), *range(0, 60, 2)], [7, 7, 9], [-3, -2, 8]])
@pytest.mark.parametrize("parallelism", [1, 2, 8])
def test_jdbc_conditions_cover_the_days_and_no_other(spark, days, parallelism):
    table = JdbcTable(spark, "t", {"url": "jdbc:x"}, parallelism=parallelism)
    conditions = table.day_predicates(days)
    assert 1 <= len(conditions) <= parallelism
    # Consecutive days are shared out too, as far as there are connections.
    assert len(conditions) >= min(parallelism, len(set(days)))
    con = duckdb.connect()
    con.execute('CREATE TABLE t AS SELECT d, unnest([d * 86400, d * 86400 + 86399]) AS "time" FROM range(-10, 200) r(d)')
    seen = [r[0] for c in conditions for r in con.execute(f"SELECT d FROM t WHERE {c.replace('`', chr(34))}").fetchall()]
    assert sorted(seen) == sorted([*set(days)] * 2)


def test_a_days_rows_are_one_file_and_a_large_days_several(spark, tmp_path):
    """Many small days from many tasks; a day that outgrows a partition's size is split."""
    table = ParquetTable(spark, str(tmp_path / "t"))
    table.create(SCHEMA)
    small = rows(spark, *[(d * DAY + s, 1.0, s) for d in range(20) for s in range(3)]).repartition(8)
    table.insert_new(small, 0, list(range(20)))
    assert len(table._store().read().inputFiles()) == 20
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        hot = spark.range(40_000).select(
            F.expr("struct(timestamp_seconds(id) AS timestamp, 0 AS partition, id AS offset)").alias("ver"),
            F.expr(f"IF(id % 50 = 0, {DAY} * (50 + id % 7), {DAY} * 40) + id").alias("time"),
            F.expr("struct(rand(1) AS `v.a`)").alias("tags"),
        )
        table.insert_new(hot.repartition(8), 1, list(range(40, 60)))
    finally:
        spark.conf.set(size, before)
    files = [f for f in table._store().read().inputFiles() if "_batch_id=1/" in f]
    days = [f.split("day=")[1].split("/")[0] for f in files]
    assert days.count("40") > 1 and all(days.count(d) == 1 for d in set(days) - {"40"})
    assert table._store().read().count() == 40_060


def test_jdbc_options_hide_the_password(spark):
    table = JdbcTable(spark, "t", {"url": "jdbc:x", "password": "secret"})
    assert "secret" not in repr(table)
