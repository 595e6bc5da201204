"""Scans, header promotion, schema checks, tables and the layered run."""

from __future__ import annotations

import datetime as dt
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from retailstrata.operators import quality
from retailstrata.plans import gold, pipeline
from retailstrata.registry import frames, queries
from retailstrata.sources import schemas, tables
from retailstrata.sources.extracts import promote_header, read_extract
from retailstrata.sources.scratch import shared_folder


def write(path, rows, **options):
    names = [f"_c{i}" for i in range(len(rows[0]))]
    pq.write_table(pa.table({n: list(col) for n, col in zip(names, zip(*rows))}), path, **options)


def test_header_of_one_file(spark, tmp_path):
    write(tmp_path / "a.parquet", [(" Id ", "Name"), ("1", "x"), ("2", None)])
    df = promote_header(spark, str(tmp_path))
    assert df.dtypes == [("Id", "string"), ("Name", "string")]
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", None)]


def test_header_is_row_zero_of_the_first_file_only(spark, tmp_path):
    folder = tmp_path / "odd name%20é"
    folder.mkdir()
    write(folder / "part-1.parquet", [("b", "1")] * 50, row_group_size=7)
    write(folder / "part-0.parquet", [("Id", None), ("a", "1"), ("Id", None)] + [("c", "2")] * 20, row_group_size=2)
    df = promote_header(spark, str(folder))
    assert df.columns == ["Id", "None"]
    assert {tuple(r): n for r, n in ((r[:2], r[2]) for r in df.groupBy(*df.columns).count().collect())} == {
        ("b", "1"): 50, ("a", "1"): 1, ("Id", None): 1, ("c", "2"): 20,
    }


def test_header_of_an_empty_extract(spark, tmp_path):
    spark.createDataFrame([], "_c0 string").write.parquet(str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no header row"):
        promote_header(spark, str(tmp_path / "e"))


def test_schema_check_names_every_problem(spark):
    df = spark.createDataFrame([("p", 1)], "productname string, stock int")
    with pytest.raises(schemas.SchemaMismatch, match="cost_price, last_stocked, warehouse, available$"):
        schemas.check_schema(df, schemas.RAW_INVENTORY)
    nested = spark.createDataFrame([("p", [1])], "productname string, stock array<int>")
    with pytest.raises(schemas.SchemaMismatch, match="cost_price, last_stocked, warehouse, available.*stock is array<int>"):
        schemas.check_schema(nested, schemas.RAW_INVENTORY)


def test_typed_columns_keep_their_types_in_bronze_and_are_read_as_text(spark, tmp_path):
    database = f"retail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    inventory = spark.createDataFrame([("p", 1.5, dt.date(2025, 3, 1), 7, "w", True)], "productName string, cost_price double, last_stocked date, stock int, warehouse string, available boolean")
    orders = frames.raw_orders(spark, SF_DIR).limit(5).withColumns({"Qty": F.lit(3.0), "Feedback_Score": F.lit(4.5)})
    returns = queries.with_header_row(frames.raw_returns(spark, SF_DIR).limit(5))
    for name, df in {"orders": orders, "returns": returns, "inventory": inventory}.items():
        df.write.parquet(f"{tmp_path}/{name}")
    layers = pipeline.Layers(database=database)
    pipeline.run_bronze(spark, *[f"{tmp_path}/{n}" for n in ("orders", "returns", "inventory")], layers=layers)
    assert dict(layers.read(spark, "bronze_inventory").dtypes)["stock"] == "int"
    pipeline.run_silver(spark, layers)
    (row,) = layers.read(spark, "silver_inventory").collect()
    assert tuple(row) == ("p", 1.5, dt.date(2025, 3, 1), 7, "W", True)
    assert {(r.Quantity, r.FeedbackScore) for r in layers.read(spark, "silver_orders").collect()} == {(3, 4.5)}


def test_header_of_the_first_file_with_rows(spark, tmp_path):
    folder = tmp_path / "some"
    folder.mkdir()
    names = pa.schema([("_c0", pa.string()), ("_c1", pa.string())])
    pq.write_table(names.empty_table(), folder / "part-0.parquet")
    pq.write_table(names.empty_table(), folder / "part-1.parquet")
    write(folder / "part-2.parquet", [("Id", "Name"), ("1", "x")])
    write(folder / "part-3.parquet", [("2", "y")])
    df = promote_header(spark, str(folder))
    assert df.columns == ["Id", "Name"] and sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y")]


def test_steps_to_be_asked_for(spark, tmp_path):
    database = f"retail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    extracts = {"orders": frames.raw_orders(spark, SF_DIR), "returns": queries.with_header_row(frames.raw_returns(spark, SF_DIR)), "inventory": frames.raw_inventory(spark, SF_DIR)}
    for name, df in extracts.items():
        df.write.parquet(f"{tmp_path}/{name}")
    layers = pipeline.Layers(database=database, fix_prefixes=True, dedup_returns=True, checked_on=dt.date(1999, 1, 1), orders_by_month=True)
    pipeline.run_all(spark, *[f"{tmp_path}/{n}" for n in extracts], layers=layers)
    orders, monthly = layers.read(spark, "silver_orders"), layers.read(spark, pipeline.MONTHLY_TABLE)
    returns = layers.read(spark, "silver_returns")
    assert monthly.count() == orders.count() and monthly.where("Order_Month IS NULL").count() == orders.where("OrderDate IS NULL").count() > 0
    assert returns.count() == returns.select("ReturnID").distinct().count() < frames.raw_returns(spark, SF_DIR).count()
    (checks,) = layers.read(spark, pipeline.CHECKS_TABLE).collect()
    assert checks.Rows == returns.count() and checks.DateNotInFuture > 0
    # A later run with the orders of some months replaces those months alone.
    some = orders.where("OrderDate >= '1996-01-01' AND OrderDate < '1996-03-01'").withColumn("Quantity", F.lit(-1))
    some.write.parquet(f"{tmp_path}/some")
    some, whole = spark.read.parquet(f"{tmp_path}/some"), monthly.count()
    layers.write(some, "silver_orders")
    pipeline.run_monthly(spark, layers)
    after = layers.read(spark, pipeline.MONTHLY_TABLE)
    assert after.count() == whole and after.where("Quantity = -1").count() == some.count() > 0


def test_a_hot_order_is_split_with_bucketed_orders(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    name = f"t_{uuid.uuid4().hex}"
    orders = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("OrderID"), F.lit(dt.date(2025, 1, 1)).alias("OrderDate"))
    tables.write_table(orders, name, path=str(tmp_path / name), buckets=4, bucket_by="OrderID")
    order = F.when(F.col("id") % 3 == 0, F.lit("o7")).otherwise(F.concat(F.lit("o"), "id"))
    returns = spark.range(0, 30_000, 1, 8).select(order.alias("OrderID"), F.col("id").cast("string").alias("ReturnID"))
    out = quality.with_order_date(returns, spark.table(name))
    assert len(out.collect()) == 30_000 and out.columns == ["OrderID", "ReturnID", "OrderDate"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkew=true" in plan or "skewed=true" in plan or "(skew=true)" in plan
    spark.sql(f"DROP TABLE {name}")


def test_read_extract_wants_the_email_column(spark, tmp_path):
    path = str(tmp_path / "orders")
    frames.raw_orders(spark, SF_DIR).drop("Email").limit(3).write.parquet(path)
    assert "Email" not in read_extract(spark, path).columns
    with pytest.raises(schemas.SchemaMismatch, match="missing columns: Email"):
        read_extract(spark, path, schemas.RAW_ORDERS)


def test_scan_reads_only_the_columns_used(spark, tmp_path):
    path = str(tmp_path / "stock")
    frames.raw_inventory(spark, SF_DIR).write.parquet(path)
    plan = read_extract(spark, path).where("stock = '3'").select("stock")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<stock:string>" in plan and "EqualTo(stock,3)" in plan


def test_table_overwrite_replaces_everything(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    tables.write_table(spark.range(5).withColumn("d$%", F.lit(1.5)), name)
    tables.write_table(spark.range(2).withColumn("d$%", F.lit(2.5)), name)
    assert sorted(map(tuple, tables.read_table(spark, name).collect())) == [(0, 2.5), (1, 2.5)]
    part = f"t_{uuid.uuid4().hex}"
    tables.write_table(spark.range(4).selectExpr("id", "id % 2 AS p"), part, path=str(tmp_path / part), partition_by=["p"])
    assert {p.name for p in (tmp_path / part).glob("p=*")} == {"p=0", "p=1"}


def test_layers_hand_over_through_tables(spark, tmp_path):
    database = f"retail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    extracts = {
        "orders": frames.raw_orders(spark, SF_DIR),
        "returns": queries.with_header_row(frames.raw_returns(spark, SF_DIR)),
        "inventory": frames.raw_inventory(spark, SF_DIR),
    }
    for name, df in extracts.items():
        df.write.parquet(f"{tmp_path}/{name}")
    layers = pipeline.Layers(database=database)
    result = pipeline.run_all(spark, *[f"{tmp_path}/{n}" for n in extracts], layers=layers)
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert names == {f"{layer}_{t}" for layer in ("bronze", "silver") for t in extracts} | {pipeline.GOLD_TABLE}
    bronze = layers.read(spark, "bronze_returns")
    assert bronze.exceptAll(frames.raw_returns(spark, SF_DIR)).count() == 0
    assert bronze.count() == frames.raw_returns(spark, SF_DIR).count()
    direct = queries.all_queries()["gold_product_kpis"](spark, SF_DIR)
    assert result.exceptAll(direct).count() == 0 and direct.count() == result.count()
    pipeline.run_all(spark, *[f"{tmp_path}/{n}" for n in extracts], layers=layers)  # reruns replace
    assert layers.read(spark, pipeline.GOLD_TABLE).count() == direct.count()


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.range(9).selectExpr("id", "id AS v", "id % 3 AS p")
    tables.write_table(tables.gathered(df, ["p"], ["id"]), name, partition_by=["p"])
    tables.replace_partitions(spark.createDataFrame([(1, 100, 7)], "p long, id long, v long"), name)
    result = sorted(map(tuple, tables.read_table(spark, name).select("id", "v", "p").collect()))
    assert result == [(0, 0, 0), (2, 2, 2), (3, 3, 0), (5, 5, 2), (6, 6, 0), (8, 8, 2), (100, 7, 1)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    plan = spark.table(name).where("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_bucketed_orders_are_not_shuffled_for_the_gold_join(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    database = f"retail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    raws = [frames.raw_orders, frames.raw_returns, frames.raw_inventory]
    silvers = [clean(raw(spark, SF_DIR)) for clean, raw in zip(pipeline.SILVER.values(), raws)]
    shuffles, results = {}, {}
    for buckets in (None, 4):
        layers = pipeline.Layers(database=database, order_buckets=buckets)
        for name, df in zip(pipeline.SILVER, silvers):
            layers.write(df, f"silver_{name}")
        result = gold.gold_product_kpis(*[layers.read(spark, f"silver_{name}") for name in pipeline.SILVER])
        plan = result._jdf.queryExecution().executedPlan().toString()
        shuffles[buckets] = plan.count("Exchange hashpartitioning(OrderID")
        results[buckets] = sorted(map(tuple, result.collect()))
    assert shuffles == {None: 2, 4: 1}
    assert results[None] == results[4]
    files = list((tmp_path / "db" / "silver_orders").glob("part-*"))
    assert len(files) == 4


def test_a_hot_partition_value_is_written_by_several_tasks(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    df = spark.range(0, 100_000, 1, 8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS p")
    tasks = tables.gathered(df, ["p"], ["id"]).select(F.spark_partition_id().alias("task"), "p")
    assert tasks.where("p = 0").select("task").distinct().count() > 1


class FakeSession:
    """The settings ``shared_folder`` looks at."""

    def __init__(self, master: str, checkpoint_dir: str | None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: checkpoint_dir or default)})()


def test_intermediate_files_go_to_the_shared_folder():
    assert shared_folder(FakeSession("yarn", "hdfs://nn/ck/")) == "hdfs://nn/ck/app-1"
    assert shared_folder(FakeSession("local[4]", None)) == shared_folder(FakeSession("local[4]", None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("yarn", None))


def test_returns_are_set_aside_in_one_pass(spark, tmp_path):
    """Accepted and rejected returns add up, the counts are those of the checks, and a run without it takes over again."""
    import datetime as dt

    database = f"retail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    extracts = {"orders": frames.raw_orders(spark, SF_DIR), "returns": queries.with_header_row(frames.raw_returns(spark, SF_DIR)), "inventory": frames.raw_inventory(spark, SF_DIR)}
    for name, df in extracts.items():
        df.write.parquet(f"{tmp_path}/{name}")
    paths = [f"{tmp_path}/{n}" for n in extracts]
    layers = pipeline.Layers(database=database, checked_on=dt.date(1999, 12, 31), set_aside=True)
    for _ in range(2):
        pipeline.run_all(spark, *paths, layers=layers)
        accepted, rejected = (layers.read(spark, t) for t in ("silver_returns", pipeline.REJECTED_TABLE))
        counts = layers.read(spark, pipeline.CHECKS_TABLE).first().asDict()
        assert accepted.count() + rejected.count() == counts["Rows"] == frames.raw_returns(spark, SF_DIR).count()
        assert rejected.count() == counts.pop("Rejected") > 0
        assert counts == queries.check_returns(spark, SF_DIR).first().asDict()
    pipeline.run_all(spark, *paths, layers=pipeline.Layers(database=database))
    assert layers.read(spark, "silver_returns").count() == counts["Rows"]
    with pytest.raises(ValueError, match="checked_on"):
        pipeline.run_silver(spark, pipeline.Layers(database=database, set_aside=True))


def test_extracts_of_several_kinds_of_files(spark, tmp_path):
    from retailstrata.sources.extracts import file_groups, missing_columns, read_mixed_extract

    path = f"{tmp_path}/an extract"
    declared = schemas._strings("name", "stock", "cost")
    kinds = [("name string, stock string, cost string", ("a", "12", "$1")), ("Name string, stock int, cost double", ("b", 12, 2.0)),
             ("cost double, stock double, name string, more int", (2.5, 7.0, "c", 1)), ("name string, stock bigint", ("d", 5))]
    for schema, row in kinds[:3]:
        spark.createDataFrame([row] * 2, schema).coalesce(1).write.mode("append").parquet(path)
    assert sorted(len(g.files) for g in file_groups(spark, path)) == [1, 1, 1]
    found = read_mixed_extract(spark, path, declared)
    assert found.schema.names == ["name", "stock", "cost"]
    assert sorted(map(tuple, found.distinct().collect())) == [("a", "12", "$1"), ("b", "12", "2"), ("c", "7", "2.5")] and found.count() == 6
    spark.createDataFrame([kinds[3][1]], kinds[3][0]).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(schemas.SchemaMismatch, match="an extract/part-.*missing columns: cost"):
        read_mixed_extract(spark, path, declared)
    assert [r["column"] for r in missing_columns(spark, path, declared).collect()] == ["cost"]
    assert ("d", "5", None) in {tuple(r) for r in read_mixed_extract(spark, path, declared, lacking=True).collect()}
    spark.createDataFrame([([1], "x", "y")], "name array<int>, stock string, cost string").write.parquet(f"{tmp_path}/odd")
    with pytest.raises(schemas.SchemaMismatch, match="array"):
        read_mixed_extract(spark, f"{tmp_path}/odd", declared)


def test_orders_by_month_are_worked_out_once(spark, monkeypatch):
    """The table and its replaced months are written from stored orders, not each from the raw rows."""
    plans, gathered = [], tables.gathered

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return gathered(df, *args)

    monkeypatch.setattr(tables, "gathered", seen)
    found = queries.partitioned_table(spark, SF_DIR)
    assert len(plans) == 2 and not any("Aggregate" in p or "Join" in p for p in plans)
    assert found.columns == ["OrderID", "ProductName", "OrderDate", "OrderAmount", "Order_Month"]


def test_tables_are_written_small_when_replaced_too(spark, tmp_path):
    name, path = f"small_{uuid.uuid4().hex[:8]}", tmp_path / "table"
    df = spark.range(8).selectExpr("id", "id % 2 AS part")
    tables.write_table(df, name, path=str(path), partition_by=["part"])
    first = set(path.rglob("*.parquet"))
    tables.replace_partitions(df.where("part = 1"), name)
    files = set(path.rglob("*.parquet"))
    rows = sorted(map(tuple, tables.read_table(spark, name).select("id", "part").collect()))
    spark.sql(f"DROP TABLE {name}")
    assert rows == [(i, i % 2) for i in range(8)] and files - first
    assert all(f.name.endswith(".zstd.parquet") for f in first | files)
