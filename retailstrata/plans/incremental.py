"""Gold KPIs from stored partial states that every load adds to.

A load brings new or changed orders, further returns (also of earlier orders) and inventory rows. Nothing that was loaded
before is aggregated again. What is stored, and added up when it is read:

* ``orders``: product, customer and amount of each order, the latest load's row counts;
* ``returns``: how many returns each order has;
* ``products``: counts and sums of orders per product, ``customers``: orders per product and customer, so that
  distinct customers stay exact, ``stock``: rows and sums of the inventory per product.

Orders that a load touches, by a row or a return, are looked up with what is known of them. What they contributed so far
is taken off and what they contribute now is added, both in one row per product (and customer) of the load. A
load counts once its name is on the list, which is written last; one that failed before left rows nobody reads, and
one that is on the list already is not added again.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.kpis import kpis_of
from ..operators.money import EXACT, added_parts, money_of, money_parts
from ..sources.scratch import exists, few_rows, release, remove, shared_folder, smaller_tasks
from ..sources.tables import COMPRESSION

STATES = {
    "orders": "OrderID string, number bigint, ProductName string, CustomerID string, OrderAmount double",
    "returns": "OrderID string, return_rows bigint, return_ids bigint",
    "products": "ProductName string, order_rows bigint, return_ids bigint, weight bigint, amount_rows bigint, "
    f"amount_values bigint, amount_fits bigint, amount_exact {EXACT}, amount_double double",
    "customers": "ProductName string, CustomerID string, orders bigint",
    "stock": "ProductName string, stock_rows bigint, stock bigint, "
    f"cost_values bigint, cost_fits bigint, cost_exact {EXACT}, cost_double double",
}


@dataclass(frozen=True)
class KpiStates:
    """States under ``path``, a folder all executors share. One writer at a time."""

    spark: SparkSession
    path: str

    # --- loads -----------------------------------------------------------------------------------------

    def loads(self) -> dict[str, str]:
        """The folder of each load that counts, in order."""
        return self._last()[1]

    def _last(self) -> tuple[int, dict[str, str]]:
        """The number of the last list, and what it says."""
        if not exists(self.spark, f"{self.path}/loads"):
            return 0, {}
        rows = self.spark.read.schema("name string, folder string, place int, version int").parquet(f"{self.path}/loads").collect()
        last = max((r["version"] for r in rows), default=0)
        return last, {r["name"]: r["folder"] for r in sorted((r for r in rows if r["version"] == last), key=lambda r: r["place"])}

    def _put_loads(self, loads: dict[str, str]) -> None:
        version = self._last()[0] + 1
        rows = [(name, folder, i) for i, (name, folder) in enumerate(loads.items())]
        frame = few_rows(self.spark, ["name", "folder", "place"], rows, "name string, folder string, place int")
        frame.write.mode("overwrite").parquet(f"{self.path}/loads/version={version}")

    def state(self, name: str) -> DataFrame:
        folders = [f"{self.path}/states/{folder}/{name}" for folder in dict.fromkeys(self.loads().values())]
        read = self.spark.read.schema(STATES[name])
        return read.parquet(*folders) if folders else self._empty(STATES[name])

    def _empty(self, schema: str) -> DataFrame:
        return few_rows(self.spark, [], [], schema)

    def _write(self, df: DataFrame, path: str) -> None:
        with smaller_tasks(self.spark):
            df.write.parquet(path, compression=COMPRESSION["parquet"])
        release(self.spark)

    # --- adding ----------------------------------------------------------------------------------------

    def add(self, load: str, orders: DataFrame | None = None, returns: DataFrame | None = None, inventory: DataFrame | None = None) -> bool:
        """Add silver rows of a load; whether it was new.

        ``orders`` have one row per OrderID (a null one is an id like any other, but no return meets it); a later row
        takes the place of an earlier one. ``returns`` and ``inventory`` add rows.
        """
        loads = self.loads()
        if load in loads:
            return False
        folder = f"{len(loads):08d}-{uuid4().hex}"
        place = f"{self.path}/states/{folder}"

        def put(df: DataFrame, name: str) -> DataFrame:
            self._write(df, f"{place}/{name}")
            return self.spark.read.schema(STATES[name]).parquet(f"{place}/{name}")

        orders = self._empty("OrderID string, ProductName string, CustomerID string, OrderAmount double") if orders is None else orders
        returns = self._empty("OrderID string, ReturnID string") if returns is None else returns
        inventory = self._empty("ProductName string, Stock int, CostPrice double") if inventory is None else inventory
        numbered = orders.select("OrderID", F.lit(len(loads)).cast("bigint").alias("number"), "ProductName", "CustomerID", "OrderAmount")
        counted = returns.where("OrderID is not null").groupBy("OrderID").agg(
            F.count(F.lit(1)).alias("return_rows"), F.count("ReturnID").alias("return_ids")
        )
        own, returned = put(numbered, "orders"), put(counted, "returns")
        work = f"{shared_folder(self.spark)}/kpis-{uuid4().hex}"
        try:
            both = self._before_and_after(own, returned)
            self._write(both, work)
            both = self.spark.read.schema(both.schema).parquet(work)
            put(self._products(both), "products")
            put(self._customers(both), "customers")
        finally:
            remove(self.spark, work)
        put(self._stock(inventory), "stock")
        self._put_loads(loads | {load: folder})
        return True

    def _before_and_after(self, own: DataFrame, returned: DataFrame) -> DataFrame:
        """Every touched order as it counted so far (``plus`` false) and as it counts now."""
        touched = own.select("OrderID").unionAll(returned.select("OrderID"))

        def known(name: str) -> DataFrame:
            state = self.state(name).alias("s")
            return state.join(touched.alias("t"), F.col("s.OrderID").eqNullSafe(F.col("t.OrderID")), "left_semi")

        def order(rows: DataFrame) -> DataFrame:
            latest = F.max(F.struct("number", "ProductName", "CustomerID", "OrderAmount"))
            return rows.groupBy("OrderID").agg(latest.alias("o")).select("OrderID", "o.ProductName", "o.CustomerID", "o.OrderAmount")

        def counts(rows: DataFrame) -> DataFrame:
            return rows.groupBy(F.col("OrderID").alias("id")).agg(F.sum("return_rows").alias("return_rows"), F.sum("return_ids").alias("return_ids"))

        def side(orders: DataFrame, returns: DataFrame, plus: bool) -> DataFrame:
            joined = order(orders).join(counts(returns), F.col("OrderID") == F.col("id"), "left").drop("id")
            return joined.withColumn("weight", F.greatest(F.coalesce("return_rows", F.lit(0)), F.lit(1)).cast("bigint")).withColumn("plus", F.lit(plus))

        if not self.loads():  # nothing is known yet
            return side(own, returned, True)
        orders, returns = known("orders"), known("returns")
        return side(orders, returns, False).unionAll(side(orders.unionAll(own), returns.unionAll(returned), True))

    @staticmethod
    def _products(both: DataFrame) -> DataFrame:
        def signed(c: Column) -> Column:
            return F.sum(F.when(F.col("plus"), c).otherwise(-c))

        weight = F.col("weight")
        return both.groupBy("ProductName").agg(
            signed(F.when(F.col("OrderID").isNotNull(), weight).otherwise(0)).alias("order_rows"),
            signed(F.coalesce("return_ids", F.lit(0))).alias("return_ids"),
            signed(weight).alias("weight"),
            signed(F.when(F.col("OrderAmount").isNotNull(), weight).otherwise(0)).alias("amount_rows"),
            *money_parts(F.col("OrderAmount") * weight, "amount", F.col("plus")),
        ).select(*[c.split()[0] for c in STATES["products"].split(", ")])

    @staticmethod
    def _customers(both: DataFrame) -> DataFrame:
        orders = F.sum(F.when(F.col("plus"), 1).otherwise(-1)).cast("bigint")
        rows = both.where("CustomerID is not null").groupBy("ProductName", "CustomerID").agg(orders.alias("orders"))
        return rows.where("orders <> 0")

    @staticmethod
    def _stock(inventory: DataFrame) -> DataFrame:
        return inventory.groupBy("ProductName").agg(
            F.count(F.lit(1)).alias("stock_rows"), F.sum("Stock").cast("bigint").alias("stock"), *money_parts(F.col("CostPrice"), "cost")
        ).select(*[c.split()[0] for c in STATES["stock"].split(", ")])

    # --- reading ---------------------------------------------------------------------------------------

    def kpis(self) -> DataFrame:
        """The gold table of all loads: what ``gold_product_kpis`` gives for all their rows."""
        counts = ("order_rows", "return_ids", "weight", "amount_rows")
        products = self.state("products").groupBy("ProductName").agg(*[F.sum(c).alias(c) for c in counts], *added_parts("amount"))
        customers = self.state("customers").groupBy("ProductName", "CustomerID").agg(F.sum("orders").alias("orders"))
        distinct = customers.where("orders > 0").groupBy(F.col("ProductName").alias("name")).agg(F.count(F.lit(1)).alias("customers"))
        stock = self.state("stock").groupBy(F.col("ProductName").alias("stocked")).agg(
            F.sum("stock_rows").alias("stock_rows"), F.sum("stock").alias("stock"), *added_parts("cost")
        )
        stock = stock.select("stocked", "stock_rows", "stock", F.try_divide(money_of("cost"), "cost_values").alias("avg_cost"))
        groups = (
            products.where("weight > 0")
            .join(distinct, F.col("ProductName").eqNullSafe(F.col("name")), "left")
            .join(stock, F.col("ProductName") == F.col("stocked"), "left")
            .withColumns({"amount": money_of("amount"), "customers": F.coalesce("customers", F.lit(0))})
        )
        return kpis_of(groups, ("ProductName",))

    def compact(self) -> None:
        """Add up the rows of all loads into one, so that reading does not slow down with their number."""
        loads = self.loads()
        if len(loads) < 2:
            return
        folder = f"{len(loads):08d}-{uuid4().hex}"
        orders = self.state("orders").groupBy("OrderID").agg(F.max(F.struct("number", "ProductName", "CustomerID", "OrderAmount")).alias("o"))
        counts = ("order_rows", "return_ids", "weight", "amount_rows")
        sums = {
            "orders": orders.select("OrderID", "o.*"),
            "returns": self.state("returns").groupBy("OrderID").agg(*[F.sum(c).alias(c) for c in ("return_rows", "return_ids")]),
            "products": self.state("products").groupBy("ProductName").agg(*[F.sum(c).alias(c) for c in counts], *added_parts("amount")),
            "customers": self.state("customers").groupBy("ProductName", "CustomerID").agg(F.sum("orders").alias("orders")).where("orders <> 0"),
            "stock": self.state("stock").groupBy("ProductName").agg(*[F.sum(c).alias(c) for c in ("stock_rows", "stock")], *added_parts("cost")),
        }
        for name, rows in sums.items():
            self._write(rows.select(*[c.split()[0] for c in STATES[name].split(", ")]), f"{self.path}/states/{folder}/{name}")
        # All loads share the folder now; it is read once.
        self._put_loads(dict.fromkeys(loads, folder))
        for old in set(loads.values()):
            remove(self.spark, f"{self.path}/states/{old}")
