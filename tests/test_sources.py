"""Readers, sinks and inspection."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cairn import sources
from cairn.operators.projection import cast_columns, spec_from_schema
from cairn.session import shared_dir


def test_seed_skips_bad_rows_and_reads_quotes(spark, tmp_path, rows):
    path = tmp_path / "seed.csv"
    path.write_text('code,label,n\nR1,"West, ""old""",1\nR2,Central,many\nR3,"two\nlines",3\n')
    assert rows(sources.load_seed(spark, str(path), "code string, label string, n int")) == [
        ("R1", 'West, "old"', 1), ("R3", "two\nlines", 3)]


def test_catalog_folder_unites_columns_and_first_description(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("entity,description\nPark, \nPark,first\nPark,second\n")
    (tmp_path / "b.csv").write_text("entity,extra,description\nCase,x,\nCase,y,case text\n")
    (tmp_path / "c 1.csv").write_text("entity,description\nPark,third\n")
    (tmp_path / "ignored.txt").write_text("entity\nNo\n")
    catalog = sources.load_catalog_dir(spark, str(tmp_path))
    assert rows(catalog.select("entity", "extra")) == [("Case", "x"), ("Case", "y")] + [("Park", None)] * 4
    assert rows(sources.entity_descriptions(catalog, "entity", "description", "_file", "_row")) == [
        ("Case", "case text"), ("Park", "first")]


def test_materialize_table_reads_back_from_the_shared_folder(spark):
    df = spark.range(5).select((F.col("id") * 2).alias("x"))
    stored = sources.materialize(df, "stored_five", "table")
    assert f"{shared_dir(spark)}/stored_five/" in stored.inputFiles()[0]
    assert sorted(r.x for r in stored.collect()) == [0, 2, 4, 6, 8]
    sources.materialize(df, "five_view", "view")
    assert spark.table("five_view").count() == 5
    with pytest.raises(ValueError):
        sources.materialize(df, "x", "cube")


def test_shared_folder_follows_the_cluster_setting(spark):
    class Conf:
        def get(self, key, default=None):
            return "/cluster/shared/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    assert shared_dir(Session()) == f"/cluster/shared/{spark.sparkContext.applicationId}"


def test_export_rejects_unknown_names(spark, tmp_path):
    models = {"a": spark.range(3), "b": spark.range(2)}
    with pytest.raises(KeyError):
        sources.export(models, str(tmp_path), "csv", ["nope"])
    with pytest.raises(ValueError):
        sources.export(models, str(tmp_path), "xml")
    written = sources.export(models, str(tmp_path), "both", ["a"])
    assert written == [f"{tmp_path}/csv/a", f"{tmp_path}/parquet/a"]
    assert spark.read.option("header", True).csv(written[0]).count() == spark.read.parquet(written[1]).count() == 3


def test_describe_list_and_sample(spark, rows):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int not null, name string")
    assert [tuple(r) for r in sources.describe(df).collect()] == [(0, "id", "int", False), (1, "name", "string", True)]
    sources.register_views({"sys.people": df})
    assert ("sys_people", 2) in {(r.table_name, r.column_count) for r in sources.list_tables(spark).collect()}
    assert rows(sources.sample(df, 1, [F.asc("id")])) == [(1, "a")]
    with pytest.raises(ValueError):
        sources.sample(df, 0)


def test_seed_rejects_the_same_rows_whatever_is_read(spark, tmp_path, rows):
    (tmp_path / "seed.csv").write_text("code,name,n\nR1,West,1\nR2,Central,many\nR3,East,3\nR4,North\nR5,South,5,x\nR6,,\n")
    seed = sources.load_seed(spark, str(tmp_path / "seed.csv"), "code string, name string, n int")
    assert rows(seed) == [("R1", "West", 1), ("R3", "East", 3), ("R6", None, None)]
    assert rows(seed.select("code")) == [("R1",), ("R3",), ("R6",)] and seed.count() == 3
    texts = sources.load_seed(spark, str(tmp_path / "seed.csv"), "code string, name string, n string")
    assert rows(texts.select("code")) == [("R1",), ("R2",), ("R3",), ("R6",)]


def test_stored_frames_do_not_overwrite_each_other(spark, tmp_path):
    first = sources.materialize(spark.range(3), "same", "table", str(tmp_path))
    second = sources.materialize(first.where("id > 0"), "same", "table", str(tmp_path))
    assert first.count() == 3 and second.count() == 2


def test_spec_from_schema_groups_and_sorts(spark):
    df = spark.sql("select 1 as n, 'x' as b, 'y' as a, true as ok, date '2024-01-01' as d, array(1) as l, 's' as _loaded, 2L as parkId, 3 as zid")
    spec = spec_from_schema(df)
    assert list(spec) == ["parkId", "zid", "a", "b", "n", "ok", "d", "l", "_loaded"]
    assert cast_columns(df, spec).columns == list(spec)
