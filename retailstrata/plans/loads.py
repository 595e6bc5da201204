"""Runs over one load of extracts at a time: what a load brings is merged and added, the rest is left as it is.

The store is a folder all executors share: ``orders`` is a listed table by month, changed rows merged by OrderID;
``returns`` and ``inventory`` are kept by load; ``kpis`` are the states the gold table is added up from. A load that failed is
run again under the same name: each step finds out by itself whether it was done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schemas
from ..sources.extracts import promote_header, read_mixed_extract
from ..sources.listed import ListedTable
from ..sources.scratch import exists
from .incremental import KpiStates
from .pipeline import MONTH
from .silver import silver_inventory, silver_orders, silver_returns


@dataclass(frozen=True)
class LoadStore:
    spark: SparkSession
    path: str

    @property
    def orders(self) -> ListedTable:
        return ListedTable(self.spark, f"{self.path}/orders", "OrderID", (MONTH,))

    @property
    def states(self) -> KpiStates:
        return KpiStates(self.spark, f"{self.path}/kpis")

    def _kept(self, df: DataFrame, table: str, load: str) -> DataFrame:
        path = f"{self.path}/{table}/load={load}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run(self, load: str, orders_path: str | None = None, returns_path: str | None = None, inventory_path: str | None = None) -> DataFrame:
        """Take in the extracts of a load and return the gold table of all loads.

        ``load`` names it, in letters, digits and dashes. An extract that a load lacks is left out. Orders' files may differ
        in types; the returns extract carries its header in the data.
        """
        if not load.replace("-", "").isalnum():
            raise ValueError(f"not a name of letters, digits and dashes: {load!r}")
        if load not in self.states.loads():
            spark, parts = self.spark, {}
            if orders_path is not None:
                orders = self._kept(silver_orders(read_mixed_extract(spark, orders_path, schemas.RAW_ORDERS)), "new-orders", load)
                dated = orders.withColumn(MONTH, F.trunc("OrderDate", "month"))
                # A list is there once the table is.
                if exists(spark, f"{self.path}/orders/lists"):
                    self.orders.merge(dated)
                else:
                    self.orders.create(dated)
                parts["orders"] = orders
            if returns_path is not None:
                raw = schemas.check_schema(promote_header(spark, returns_path), schemas.RAW_RETURNS, returns_path)
                parts["returns"] = self._kept(silver_returns(raw), "returns", load)
            if inventory_path is not None:
                raw = read_mixed_extract(spark, inventory_path, schemas.RAW_INVENTORY)
                parts["inventory"] = self._kept(silver_inventory(raw), "inventory", load)
            self.states.add(load, **parts)
        return self.states.kpis()
