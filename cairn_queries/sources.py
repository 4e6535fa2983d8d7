"""Readers and sinks: whole tables written, read back and compared with their source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import sources
from cairn.operators.reshape import union_conformed
from cairn.session import shared_dir
from cairn_queries.fixtures import Tables
from cairn_queries.registry import query


def fresh_folder(t: Tables) -> str:
    return f"{shared_dir(t.spark)}/{uuid.uuid4().hex}"


@query("source_tables", "A1", """
    select o_orderkey, c_name, l_linenumber from orders join customer on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    def load(table: str) -> DataFrame:
        return sources.load_source(t.spark, t.sf_dir, "driver", table, layout="{root}/{table}.parquet")

    sources.register_views({f"driver.{name}": load(name) for name in ("orders", "customer", "lineitem")})
    return t.spark.sql("""
        select o_orderkey, c_name, l_linenumber from driver_orders join driver_customer on c_custkey = o_custkey
        join driver_lineitem on l_orderkey = o_orderkey""")


SEED_SCHEMA = "p_partkey bigint, label string, price decimal(10,2)"


def written_seed(t: Tables) -> str:
    """A seed of all parts, with a row that does not fit after every fifth: a key or a price of the wrong type, or no price."""
    path = fresh_folder(t)
    quoted = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    key, price = F.col("p_partkey").cast("string"), F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    label = F.when(F.col("p_partkey") % 3 == 0, quoted).otherwise(F.col("p_name"))
    line = lambda *fields: F.concat_ws(",", *fields)
    in_quotes = F.concat(F.lit('"'), F.replace(label, F.lit('"'), F.lit('""')), F.lit('"'))
    bad = F.when(F.col("p_partkey") % 15 == 0, line(F.lit("k"), in_quotes, price)).when(
        F.col("p_partkey") % 15 == 5, line(key, in_quotes, F.lit("free"))).otherwise(line(key, in_quotes))
    lines = F.when(F.col("p_partkey") % 5 == 0, F.array(line(key, in_quotes, price), bad)).otherwise(F.array(line(key, in_quotes, price)))
    # every file with its header line
    files = t.part.select(F.explode(lines).alias("value")).repartition(3)
    head = files.groupBy(F.spark_partition_id().alias("file")).agg(F.lit("p_partkey,label,price").alias("value"))
    placed = files.select(F.spark_partition_id().alias("file"), "value", F.lit(1).alias("at")).unionAll(head.select("file", "value", F.lit(0)))
    placed.repartition(3, "file").sortWithinPartitions("file", "at").select("value", "file").write.partitionBy("file").text(path)
    return path


@query("seed_round_trip", "A2", """
    select p_partkey, if(p_partkey % 3 = 0, p_name || ', "' || p_brand || '"', p_name) as label, cast(p_retailprice as decimal(10,2)) as price from part""")
def _(t: Tables) -> DataFrame:
    return sources.load_seed(t.spark, written_seed(t), SEED_SCHEMA)


@query("seed_read_pruned", "A2", "select p_partkey from part")
def _(t: Tables) -> DataFrame:
    # rows are judged by all their fields, also when one is asked for
    return sources.load_seed(t.spark, written_seed(t), SEED_SCHEMA).select("p_partkey")


@query("catalog_folder", "A3", """
    select p_brand as entity, p_name as attribute, p_type as semantic, null as display from part
    union all select s_name, 'a' || s_suppkey, null, 'Supplier ' || s_suppkey from supplier""")
def _(t: Tables) -> DataFrame:
    # one folder of many files with two headers
    path = fresh_folder(t)
    t.part.repartition(5).select(F.col("p_brand").alias("entity"), F.col("p_name").alias("attribute"), F.col("p_type").alias("semantic")
                  ).write.option("header", True).csv(path)
    k = F.col("s_suppkey").cast("string")
    t.supplier.select(F.concat(F.lit("Supplier "), k).alias("display"), F.col("s_name").alias("entity"),
                      F.concat(F.lit("a"), k).alias("attribute")).repartition(3).write.mode("append").option("header", True).csv(path)
    return sources.load_catalog_dir(t.spark, path).select("entity", "attribute", "semantic", "display")


@query("entity_first_description", "A3", """
    select source as entity, arg_min(text, doc_id) as description from documents where trim(text, ' ') <> '' group by source""")
def _(t: Tables) -> DataFrame:
    entries = t.documents.select(F.col("source").alias("entity"), F.col("text").alias("description"), "doc_id")
    return sources.entity_descriptions(entries, "entity", "description", "doc_id")


@query("materialize_table", "A4", "select o_custkey, count(*) as n, max(o_orderdate) as last_order from orders group by o_custkey")
def _(t: Tables) -> DataFrame:
    grouped = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_order"))
    lazy = sources.materialize(grouped, "orders_by_customer", "view")
    return sources.materialize(lazy, f"orders_by_customer_{uuid.uuid4().hex}", "table")


@query("export_csv_and_parquet", "A5", """
    select f, o_orderkey, o_orderstatus, o_orderdate from orders, (values ('csv'), ('parquet')) v(f)""")
def _(t: Tables) -> DataFrame:
    model = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    csv, parquet = sources.export({"orders_out": model, "unused": t.region}, fresh_folder(t), "both", ["orders_out"])
    read = t.spark.read.schema(model.schema).option("header", True).csv(csv)
    return union_conformed([read.withColumn("f", F.lit("csv")), t.spark.read.parquet(parquet).withColumn("f", F.lit("parquet"))])


ALL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
       "benchmark", "labels", "conversations")
COLUMN_COUNTS = (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4)


@query("table_overview", "A7", " union all ".join(
    f"select '{name}' as table_name, {n} as column_count, count(*) as row_count from {name}" for name, n in zip(ALL, COLUMN_COUNTS)))
def _(t: Tables) -> DataFrame:
    return sources.table_overview({name: getattr(t, name) for name in ALL})


@query("table_listing", "A7", " union all ".join(
    f"select 'listed_{name}' as table_name, 'TEMPORARY' as table_type, {n} as column_count, count(*) as row_count from {name}"
    for name, n in zip(ALL, COLUMN_COUNTS)))
def _(t: Tables) -> DataFrame:
    frames = {f"listed_{name}": getattr(t, name) for name in ALL}
    sources.register_views(frames)
    counts = sources.table_overview(frames).select("table_name", "row_count")
    return sources.list_tables(t.spark).join(counts, "table_name").select("table_name", "table_type", "column_count", "row_count")


@query("described_columns", "A6", """
    select 0 as position, 'event_id' as column_name, 'bigint' as data_type, true as nullable, count(event_id) as filled_rows from events
    union all select 1, 'ts', 'timestamp_ntz', true, count(ts) from events union all select 2, 'user_id', 'bigint', true, count(user_id) from events
    union all select 3, 'event_type', 'string', true, count(event_type) from events union all select 4, 'value', 'double', true, count(value) from events
    union all select 5, 'props', 'string', true, count(props) from events""")
def _(t: Tables) -> DataFrame:
    from cairn.operators.profile import wide_stats

    filled = wide_stats(t.events, t.events.columns, {"filled_rows": ("bigint", F.count)})
    return sources.describe(t.events).join(filled, "column_name").select(
        "position", "column_name", "data_type", "nullable", "filled_rows")


@query("sample_in_order", "A8", "select * from lineitem order by l_orderkey desc, l_linenumber, l_partkey, l_suppkey, l_quantity limit 25")
def _(t: Tables) -> DataFrame:
    return sources.sample(t.lineitem, 25, [
        F.desc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_quantity")])
