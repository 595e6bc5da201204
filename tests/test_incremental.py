"""KPIs from states that loads add to, against the gold table of all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_gold import INVENTORY, ORDERS, RETURNS, bag, make_tables

from retailstrata.plans import gold
from retailstrata.plans.incremental import KpiStates


def parts_of(df, n, seed):
    rows = df.collect()
    random.Random(seed).shuffle(rows)
    return [df.sparkSession.createDataFrame(rows[i::n], df.schema) for i in range(n)]


@pytest.mark.parametrize("seed, hot", [(11, False), (12, True)])
def test_states_of_loads_give_the_gold_table_of_all_rows(spark, tmp_path, seed, hot):
    orders, returns, inventory = make_tables(spark, seed, hot)
    orders = orders.groupBy("OrderID").agg(F.min(F.struct(*orders.columns[1:])).alias("r")).select("OrderID", "r.*")
    states = KpiStates(spark, f"{tmp_path}/states")
    assert states.kpis().count() == 0
    for i, tables in enumerate(zip(*(parts_of(df, 3, seed) for df in (orders, returns, inventory)))):
        assert states.add(f"load {i}", *tables)
    expected = gold.gold_product_kpis(orders, returns, inventory)
    assert states.kpis().dtypes == expected.dtypes
    assert bag(states.kpis()) == bag(expected)
    assert not states.add("load 1", orders, returns, inventory), "a load counts once"
    states.compact()
    assert bag(states.kpis()) == bag(expected)
    assert not states.add("load 2", orders) and states.add("load 3", inventory=inventory)
    assert bag(states.kpis()) == bag(gold.gold_product_kpis(orders, returns, inventory.unionAll(inventory)))


def test_changed_orders_take_the_place_of_earlier_ones(spark, tmp_path):
    states = KpiStates(spark, f"{tmp_path}/states")
    first = [("a", "c1", "p", 10.0, None), ("b", "c1", "p", 5.0, None), (None, "c2", "p", 1.0, None)]
    changed = [("a", "c3", "q", 11.0, None), (None, "c2", "p", None, None)]
    returns = [("r1", "a", *[None] * 7), ("r2", "a", *[None] * 7), (None, "b", *[None] * 7), ("r9", None, *[None] * 7)]
    orders, later, back = (spark.createDataFrame(rows, s) for rows, s in ((first, ORDERS), (changed, ORDERS), (returns, RETURNS)))
    stock = spark.createDataFrame([("q", 2.0, None, 3, "A", True), ("q", None, None, None, "B", True)], INVENTORY)
    states.add("1", orders, None, stock)
    states.add("2", None, back)
    states.add("3", later)
    now = spark.createDataFrame([changed[0], first[1], changed[1]], ORDERS)
    assert bag(states.kpis()) == bag(gold.gold_product_kpis(now, back, stock))
    states.add("4", spark.createDataFrame([("b", "c1", "q", 5.0, None), (None, "c2", "q", 2.0, None)], ORDERS))
    assert [r["ProductName"] for r in states.kpis().collect()] == ["q"], "a product without orders is none"


def test_a_failed_load_does_not_count(spark, tmp_path, monkeypatch):
    orders, returns, inventory = make_tables(spark, 3)
    orders = orders.dropDuplicates(["OrderID"])
    orders.write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    states = KpiStates(spark, f"{tmp_path}/states")
    monkeypatch.setattr(KpiStates, "_put_loads", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        states.add("1", orders, returns, inventory)
    monkeypatch.undo()
    assert states.loads() == {} and states.kpis().count() == 0
    assert states.add("1", orders, returns, inventory)
    assert bag(states.kpis()) == bag(gold.gold_product_kpis(orders, returns, inventory))


def test_amounts_that_fit_no_decimal(spark, tmp_path):
    rows = [[("a", "c", "p", 1e300, None)], [("b", "c", "p", 1e299, None), ("c", "c", "q", 0.1, None)], [("d", "c", "q", 0.2, None)]]
    states = KpiStates(spark, f"{tmp_path}/states")
    for i, part in enumerate(rows):
        states.add(str(i), spark.createDataFrame(part, ORDERS))
    found = {r["ProductName"]: r["Total_Revenue"] for r in states.kpis().collect()}
    assert found == {"p": 1e300 + 1e299, "q": 0.3}


def shuffled_rows(spark, work) -> int:
    """Rows that ``work`` writes for shuffles."""
    store, no = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def total():
        stages = store.stageList(None, False, False, no, None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    work()
    return total() - before


def test_a_load_moves_its_orders_by_id_once(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    n = 20_000
    df = spark.range(n).select(F.concat(F.lit("o"), "id").alias("OrderID"), F.lit("c").alias("CustomerID"), F.concat(F.lit("p"), F.col("id") % 5).alias("ProductName"), F.lit(1.5).alias("OrderAmount"))
    df.write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    states = KpiStates(spark, f"{tmp_path}/states")
    assert shuffled_rows(spark, lambda: states.add("first", orders)) < 1.2 * n, "nothing is known that could be touched"
    again = orders.withColumn("OrderAmount", F.lit(2.5))
    # The known orders and the ids of the load to meet, the known ones to find their last state, and both for the new one.
    assert shuffled_rows(spark, lambda: states.add("second", again)) < 5.2 * n
    assert {(r["ProductName"], r["Total_Orders"], r["Total_Revenue"]) for r in states.kpis().collect()} == {(f"p{i}", n // 5, n // 5 * 2.5) for i in range(5)}
