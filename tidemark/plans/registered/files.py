"""File sources and sinks, catalog tables, file statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ...session import scratch_dir
from ...sinks import (create_managed, create_schema, describe_kv as describe, drop_table, register_external,
                      write_delimited, write_json, write_parquet)
from ...operators import ZoneMap, file_inventory as inventory, file_zones, partition_counts, publish_partitioned, zorder_layout
from ...operators.layout import folder_size
from ...sources import (read_delimited as delimited, read_inferred_once, read_json_lines, read_split_csv, read_parquet_dir as parquet_dir,
                        read_text_lines as text_lines)
from ..change_table import ChangeTable
from .registry import fresh, query, table


def _own_name(label: str) -> str:
    """A table name no other application uses, where the catalog is shared."""
    return f"tidemark_{label}_{uuid.uuid4().hex[:8]}"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def read_delimited(spark, sf):
    """CSV written and read back with inferred types."""
    orders, path = table(spark, sf, "orders"), fresh(spark, "csv")
    write_delimited(orders, path)
    back = delimited(spark, path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema])


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    c_acctbal, c_mktsegment FROM customer""")
def read_delimited_as_text(spark, sf):
    path = fresh(spark, "csv-text")
    write_delimited(table(spark, sf, "customer"), path)
    return delimited(spark, path, infer=False).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def read_delimited_inferred_once(spark, sf):
    """As above, with the files opened once."""
    orders, path = table(spark, sf, "orders"), fresh(spark, "csv-once")
    write_delimited(orders, path)
    back = read_inferred_once(spark, path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema])


@query("SELECT * FROM documents")
def csv_documents_split(spark, sf):
    """The same texts from files of any size, by a task per split; no task writes more than it read of the table."""
    docs, path = table(spark, sf, "documents"), fresh(spark, "csv-split")
    write_delimited(docs, path)
    return read_split_csv(spark, path, docs.schema)


@query("SELECT * FROM documents")
def csv_documents_roundtrip(spark, sf):
    """Texts with line breaks, quotes and blanks come back from CSV as they were."""
    docs, path = table(spark, sf, "documents"), fresh(spark, "csv-documents")
    write_delimited(docs, path)
    return delimited(spark, path, schema=docs.schema)


@query("SELECT * FROM orders")
def external_partitioned(spark, sf):
    """A partitioned folder keeps all its rows through registering, dropping and registering again."""
    orders, path, name = table(spark, sf, "orders"), fresh(spark, "by-status"), _own_name("orders_by_status")
    write_parquet(orders, path, partition_by=["o_orderstatus"])
    register_external(spark, name, path)
    drop_table(spark, name)
    return register_external(spark, name, path)     # the catalog lists the partitions when the rows are read


@query("SELECT * FROM part")
def read_parquet_dir(spark, sf):
    path = fresh(spark, "parquet")
    write_parquet(table(spark, sf, "part"), path)
    return parquet_dir(spark, path)


@query("SELECT * FROM customer")
def json_roundtrip(spark, sf):
    customer, path = table(spark, sf, "customer"), fresh(spark, "json")
    write_json(customer, path)
    return read_json_lines(spark, path, customer.schema)


@query("""SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""")
def parquet_union(spark, sf):
    one, two = fresh(spark, "union"), fresh(spark, "union")
    write_parquet(table(spark, sf, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nationkey", "c_acctbal AS acctbal"), one)
    write_parquet(table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS acctbal", "s_name AS name", "s_nationkey AS nationkey"), two)
    return parquet_dir(spark, one).unionByName(parquet_dir(spark, two))


@query("SELECT UNNEST(string_split(text, chr(10))) AS value FROM documents")
def read_text_lines(spark, sf):
    path = fresh(spark, "text")
    table(spark, sf, "documents").select("text").write.text(path)
    return text_lines(spark, path)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_table_query(spark, sf):
    """CSV files under a table name; the name can go, the files stay."""
    path, name = fresh(spark, "csv-table"), _own_name("orders_csv")
    write_delimited(table(spark, sf, "orders"), path)
    drop_table(spark, name)
    register_external(spark, name, path, "csv", header="true", inferSchema="true")
    out = spark.sql(f"SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, o_totalprice "
                    f"FROM {name} ORDER BY o_orderkey")
    drop_table(spark, name)
    return out


@query("SELECT * FROM supplier")
def drop_recreate(spark, sf):
    """Dropping an external table keeps the files, so it can be registered again."""
    path, name = fresh(spark, "external"), _own_name("supplier_external")
    write_parquet(table(spark, sf, "supplier"), path)
    drop_table(spark, name)
    register_external(spark, name, path)
    drop_table(spark, name)
    out = register_external(spark, name, path)
    drop_table(spark, name)
    return out


@query("SELECT 'Provider' AS key, 'parquet' AS value UNION ALL SELECT 'Type', 'MANAGED' UNION ALL SELECT 'o_orderkey', 'bigint'")
def describe_kv(spark, sf):
    """Chosen facts about a managed table made from a query."""
    schema = _own_name("describe")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{scratch_dir(spark, 'schema')}'")
    name = f"{schema}.orders_managed"
    create_managed(table(spark, sf, "orders"), name)
    rows = describe(spark, name, {"Provider", "Type", "o_orderkey"}).collect()      # three rows
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return spark.createDataFrame(rows, "key string, value string")


@query("SELECT c_mktsegment, COUNT(*) AS cnt FROM customer GROUP BY c_mktsegment", name="create_managed")
def managed_table_counts(spark, sf):
    schema = _own_name("managed")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{scratch_dir(spark, 'schema')}'")
    create_schema(spark, schema)
    managed = create_managed(table(spark, sf, "customer"), f"{schema}.customer_managed",
                             partition_by=["c_mktsegment"])
    return partition_counts(managed, "c_mktsegment")


@query("SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder, TRUE AS has_bytes FROM orders")
def file_inventory(spark, sf):
    """Files below a partitioned folder, summed up per partition folder."""
    path = fresh(spark, "inventory")
    write_parquet(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    files = inventory(spark, path)
    return (files.groupBy(F.regexp_extract("path", "(o_orderstatus=[^/]*)/", 1).alias("folder"))
            .agg((F.sum("length") > 0).alias("has_bytes")).filter("folder <> ''"))


@query("""SELECT 'CREATE TABLE AS SELECT' AS operation, COUNT(*) AS rows_added, CAST(0 AS BIGINT) AS rows_removed, 1 AS commits FROM orders
    UNION ALL SELECT 'UPDATE', COUNT(*), COUNT(*), 2 FROM (SELECT 1 FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 1 FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'DELETE', 0, COUNT(*), 1 FROM orders WHERE o_totalprice < 50000""")
def commit_metrics(spark, sf):
    """What the commits of each kind did, summed up from the table's own history."""
    t = ChangeTable.create(spark, fresh(spark, "metrics"), table(spark, sf, "orders"))
    t.update("o_orderstatus = 'F'", {"o_orderpriority": "none"})
    t.update("o_orderstatus = 'O'", {"o_orderpriority": "some"})
    t.delete("o_totalprice < 50000")
    return t.history().groupBy("operation").agg(
        F.sum("rows_added").alias("rows_added"), F.sum("rows_removed").alias("rows_removed"), F.count("*").cast("int").alias("commits"))


@query("""SELECT 'month=' || strftime(o_orderdate, '%Y-%m') AS path, COUNT(*) AS num_records,
    CAST(MIN(o_orderkey) AS VARCHAR) AS min_key, CAST(MAX(o_orderkey) AS VARCHAR) AS max_key FROM orders GROUP BY 1""")
def file_statistics(spark, sf):
    """Rows and key range of the files of each month, as they lie on disk."""
    path = fresh(spark, "months")
    publish_partitioned(table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM")), path, ["month"])
    files = file_zones(spark.read.parquet(path), ["o_orderkey"])
    return files.groupBy(F.regexp_extract("file", "/(month=[^/]*)/", 1).alias("path")).agg(
        F.sum("rows").alias("num_records"), F.min("o_orderkey_min").cast("string").alias("min_key"), F.max("o_orderkey_max").cast("string").alias("max_key"))


@query("""SELECT 'o_orderstatus=' || o_orderstatus AS folder, COUNT(*) AS num_rows, MIN(o_totalprice) AS least, MAX(o_totalprice) AS greatest,
    MIN(o_orderdate) AS first_date, MAX(o_orderdate) AS last_date FROM orders GROUP BY 1""")
def file_zone_map(spark, sf):
    """The zone map of a partitioned folder, added up by folder."""
    path = fresh(spark, "zones")
    write_parquet(table(spark, sf, "orders").repartition(4), path, partition_by=["o_orderstatus"])
    zones = ZoneMap.build(spark, path, fresh(spark, "zone-map"), ["o_totalprice", "o_orderdate"]).zones()
    return zones.groupBy(F.regexp_extract("file", "/(o_orderstatus=[^/]*)/", 1).alias("folder")).agg(
        F.sum("rows").alias("num_rows"), F.min("o_totalprice_min").alias("least"), F.max("o_totalprice_max").alias("greatest"),
        F.min("o_orderdate_min").alias("first_date"), F.max("o_orderdate_max").alias("last_date"))


@query("SELECT *, TRUE AS few_files FROM lineitem WHERE l_partkey BETWEEN 20 AND 24 AND l_quantity <= 30")
def zone_pruned_lookup(spark, sf):
    """A lookup in a clustered copy of lineitem opens less than half of its files."""
    path, source = fresh(spark, "zone-lines"), f"{sf}/lineitem.parquet"
    zorder_layout(spark, source, path, ["l_partkey", "l_shipdate"], target_bytes=max(1, folder_size(spark, source)[0] // 24))
    zones = ZoneMap.build(spark, path, fresh(spark, "zone-map"), ["l_partkey", "l_quantity"])
    found = zones.between(l_partkey=(20, 24), l_quantity=(None, 30))
    return found.rows.withColumn("few_files", F.lit(2 * found.files < found.of))
