import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (ZoneMap, compact_files, file_inventory, largest_file, partition_advice, publish_partitioned,
                                zorder_layout)
from tidemark.sinks import (create_managed, describe_kv, drop_table, register_external, write_delimited,
                            write_json, write_parquet)
from tidemark.sources import (read_delimited, read_inferred_once, read_json_lines, read_parquet_dir, read_split_csv,
                              read_text_lines)


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(i, n, t, datetime(2026, 1, 1, i)) for i, n, t in
         [(1, "Ada", "files"), (2, "Bo", "tables"), (3, "Cy", "spark"), (4, "Di", "merge")]],
        "id bigint, name string, topic string, ts timestamp")


def test_csv_types(spark, people, path, rows):
    p = path()
    write_delimited(people, p, single_file=True)
    assert [f.dataType.simpleString() for f in read_delimited(spark, p, infer=False).schema] == ["string"] * 4
    assert [f.dataType.simpleString() for f in read_delimited(spark, p).schema] == [
        "int", "string", "string", "timestamp"]
    assert rows(read_delimited(spark, p, schema=people.schema)) == rows(people)


def test_csv_quoted_line_breaks(spark, path, rows):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"')], "id int, s string")
    p = path()
    df.write.option("header", True).option("escape", '"').csv(p)
    assert rows(read_delimited(spark, p, multiline=True)) == [(1, 'two\nlines, "quoted"')]


def test_parquet_json_text(spark, people, path, rows):
    a, b, c = path(), path(), path()
    write_parquet(people, a)
    assert rows(read_parquet_dir(spark, a)) == rows(people)
    write_json(people, b)
    assert rows(read_json_lines(spark, b, people.schema)) == rows(people)
    people.select("name").write.text(c)
    assert rows(read_text_lines(spark, c)) == [("Ada",), ("Bo",), ("Cy",), ("Di",)]


def test_inventory(spark, path):
    p = path()
    spark.range(10).coalesce(1).write.parquet(f"{p}/small")
    spark.range(100_000).coalesce(1).write.parquet(f"{p}/large")
    files = file_inventory(spark, p).filter("path LIKE '%.parquet'")
    assert files.count() == 2
    assert "/large/" in largest_file(spark, p).first()["path"]
    # names are listed without opening the files
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_managed_goes_external_stays(spark, people, path, rows):
    p = path()
    write_parquet(people, p)
    create_managed(people, "people_managed")
    register_external(spark, "people_external", p)
    kv = lambda name: dict(rows(describe_kv(spark, name, {"Type", "Provider", "id"})))
    assert kv("people_managed") == {"Type": "MANAGED", "Provider": "parquet", "id": "bigint"}
    assert kv("people_external") == {"Type": "EXTERNAL", "Provider": "parquet", "id": "bigint"}
    location = dict(rows(describe_kv(spark, "people_managed", {"Location"})))["Location"]
    drop_table(spark, "people_managed")
    drop_table(spark, "people_external")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(location)
    assert rows(spark.read.parquet(p)) == rows(people)
    assert register_external(spark, "people_external", p).count() == 4
    drop_table(spark, "people_external")


def test_csv_table(spark, people, path):
    p = path()
    write_delimited(people, p)
    register_external(spark, "people_csv", p, "csv", header="true", inferSchema="true")
    assert [r.id for r in spark.sql("SELECT * FROM people_csv ORDER BY id").collect()] == [1, 2, 3, 4]
    drop_table(spark, "people_csv")


def test_publish_prunes_partitions(spark, path, rows):
    df = spark.range(100).selectExpr("id", "date_add(DATE '2026-01-01', int(id % 4)) AS day")
    out = publish_partitioned(df, path(), ["day"])
    assert rows(out, "id", "day") == rows(df)
    one = out.filter("day = DATE '2026-01-02'")
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().toString()
    assert one.count() == 25


def test_compact_and_zorder_keep_rows(spark, path, rows):
    src = path()
    df = spark.range(2000).selectExpr("id", "id * 37 % 101 AS a", "concat('k', id % 13) AS b",
                                      "if(id % 3 = 0, 5, id) AS hot")
    df.repartition(12).write.parquet(src)
    packed = compact_files(spark, src, path("packed"))
    assert rows(packed) == rows(df) and len(packed.inputFiles()) == 1
    for columns in (["a"], ["a", "b"], ["hot"]):
        out = zorder_layout(spark, src, path("z"), columns, target_bytes=6_000)
        assert rows(out) == rows(df)
        files = out.select(F.input_file_name().alias("f")).groupBy("f").count()
        assert files.count() > 2
        # a value in a third of the rows does not end up in one file
        assert files.agg(F.max("count")).first()[0] < 900


def test_zorder_narrows_file_ranges(spark, path):
    src = path()
    df = spark.range(4000).selectExpr("id * 7919 % 4001 AS x", "id * 104729 % 4001 AS y")
    df.write.parquet(src)
    out = zorder_layout(spark, src, path("z"), ["x", "y"], target_bytes=5_000)
    spans = out.groupBy(F.input_file_name()).agg(
        (F.max("x") - F.min("x")).alias("sx"), (F.max("y") - F.min("y")).alias("sy"))
    widest = spans.agg(F.avg("sx"), F.avg("sy")).first()
    assert widest[0] < 3000 and widest[1] < 3000


def test_partition_values_come_back_as_they_were(spark, path, rows):
    """Only a type whose text is the folder's name is taken for the column's."""
    src = path("day=7")        # a name like a partition's above the folder is none of its columns
    values = ["007", "08", "1e3", None, "x y", "a=b", "5"]
    df = spark.createDataFrame([(i, v, i % 2, date(2026, 1, 1 + i % 3)) for i, v in enumerate(values)], "id int, code string, n int, d date")
    df.write.partitionBy("code", "n", "d").parquet(src)
    expected = rows(df.select("id", "code", "n", "d"))
    for out in (compact_files(spark, src, path("packed")), zorder_layout(spark, src, path("z"), ["id"])):
        assert rows(out, "id", "code", "n", "d") == expected
        assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "int", "date"]


def test_cuts_are_quantiles_of_any_type(spark):
    from tidemark.operators.layout import value_cuts
    df = spark.range(6000).selectExpr("id", "cast(id as decimal(12,3)) as money", "if(id % 2 = 0, double('nan'), id * 1.5d) as x", "concat('same prefix of text ', lpad(id, 6, '0')) as s",
                                      "cast(null as bigint) as none", "if(id < 5000, 7L, id) as hot")
    cuts = value_cuts(df, 3)
    assert [len(c) for c in cuts] == [7, 7, 7, 7, 0, 7]
    for i, c in enumerate(cuts[0]):
        assert abs(c - 750 * (i + 1)) < 100
    assert abs(float(cuts[1][3]) - 3000) < 100 and abs(cuts[2][3] - 4500) < 200 and cuts[3] == sorted(cuts[3])
    assert cuts[5][:6] == [7] * 6 and cuts[5][6] > 7


def test_zone_map_reads_only_files_that_can_matter(spark, path, rows):
    src = path("src")
    df = spark.range(3000).selectExpr("id", "if(id % 10 = 0, null, id % 50) as v", "concat('0', id % 3) as part")
    df.repartitionByRange(8, "id").write.partitionBy("part").parquet(src)
    zones = ZoneMap.build(spark, src, path("map"), ["id", "v"])
    assert zones.zones().agg(F.sum("rows"), F.sum("v_nulls")).first()[:] == (3000, 300)
    found = zones.between(id=(100, 200))
    assert found.files < found.of and rows(found.rows, "id", "v", "part") == rows(df.filter("id between 100 and 200"))
    assert len(found.rows.inputFiles()) == found.files
    assert rows(zones.between(id=(2900, None), v=(None, 3)).rows, "id", "v", "part") == rows(df.filter("id >= 2900 and v <= 3"))
    none = zones.between(id=(5000, None))
    assert none.files == 0 and none.rows.count() == 0 and none.rows.columns == ["id", "v", "part"]


@pytest.mark.parametrize("split", [37, 200, 5000])
def test_csv_records_begin_in_any_split(spark, path, rows, split):
    """Quotes, doubled quotes, separators and line breaks at every place of a split."""
    rng = random.Random(split)
    text = lambda: "".join(rng.choice(['a', 'b', ' ', '"', ',', "\n", "\r\n", "é", '""', "\n\n"]) for _ in range(rng.randint(0, 25)))
    items = [(i, rng.choice([None, "", text(), text(), text() * 30 if i % 20 == 0 else text()]), rng.random() < 0.5) for i in range(150)]
    df = spark.createDataFrame(items, "id int, t string, ok boolean")
    p = path()
    write_delimited(df.repartitionByRange(2, "id"), p)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        if split < 5000:
            assert spark.read.text(p).rdd.getNumPartitions() > 5
        assert rows(read_split_csv(spark, p, df.schema)) == rows(df)
        named = read_split_csv(spark, p)
        assert named.columns == ["id", "t", "ok"] and rows(named, "t") == rows(df, "t")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_types_are_inferred_in_the_one_read(spark, path, rows):
    p = path()
    shape = "a string, b string, c string, d string, e string, f string, g string, h string, `i.j` string, k string"
    items = [("1", "1", "1.5", "2024-01-01", "2024-01-01 10:00:00", "true", "x", None, "3000000000", "2024-13-01"),
             ("-07", "x", "1e3", "2024-02-29", "2024-01-01T10:00:00Z", "FALSE", "1", None, "1", "2024-01-01"), (None, None, None, None, None, None, None, None, None, None)]
    write_delimited(spark.createDataFrame(items, shape), p)
    out = read_inferred_once(spark, p)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "double", "date", "timestamp", "boolean", "string", "string", "bigint", "string"]
    assert rows(out, "a", "c", "g", "`i.j`") == sorted([(1, 1.5, "x", 3_000_000_000), (-7, 1000.0, "1", 1), (None, None, None, None)], key=repr)
    assert out.columns == [c.strip("`") for c in ["a", "b", "c", "d", "e", "f", "g", "h", "i.j", "k"]]
    assert not any(f.startswith(p) for f in out.inputFiles())


def test_partition_advice(spark):
    df = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('v', id % 40)) AS few", "if(id % 4 = 0, null, 'x') AS one", "concat('k', id) AS many")
    told = {r["candidate"]: r for r in partition_advice(df, ["few", "one", "many"], target_bytes=8 * 20_000).collect()}
    assert told["few"]["folders"] == 41 and abs(told["few"]["hot_share"] - 1 / 3) < 0.01 and told["few"]["advised"]
    assert told["one"]["folders"] == 2 and abs(told["one"]["hot_share"] - 0.75) < 0.01 and abs(told["many"]["folders"] - 20_000) < 1000
    assert not any(r["advised"] for r in partition_advice(df, ["many"]).collect())
    assert [r["folders"] for r in partition_advice(df.limit(0), ["few"]).collect()] == [0]
