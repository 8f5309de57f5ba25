"""Inputs of the registered queries: the fixture adapters over one test-data folder."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stocklens.params import RunParams
from stocklens.sources import testdata

AS_OF = dt.date(2001, 6, 30)
DEFAULT_PARAMS = RunParams(as_of=AS_OF, lookback_days=90)


@dataclass
class Inputs:
    """Lazy fixture frames for one (session, folder, params, sku rule)."""

    spark: SparkSession
    sf_dir: str
    params: RunParams = DEFAULT_PARAMS
    sku: str = "brand"

    @cached_property
    def rated_sales(self) -> DataFrame:
        """Pruned to the run window, which every pipeline filters."""
        return testdata.rated_sales(self.spark, self.sf_dir, self.sku, (self.params.start, self.params.as_of))

    @cached_property
    def quantity_sales(self) -> DataFrame:
        """Pruned to what can be invoiced in the run window, which every pipeline filters."""
        return testdata.quantity_sales(self.spark, self.sf_dir, (self.params.start, self.params.as_of))

    @cached_property
    def all_quantity_sales(self) -> DataFrame:
        return testdata.quantity_sales(self.spark, self.sf_dir)

    @cached_property
    def stock(self) -> DataFrame:
        return testdata.stock(self.spark, self.sf_dir, self.params.as_of, self.sku)

    @cached_property
    def gef(self) -> DataFrame:
        return testdata.gef(self.spark, self.sf_dir, self.params.as_of, self.sku)

    @cached_property
    def supply_plan_stock(self) -> DataFrame:
        return testdata.supply_plan_stock(self.spark, self.sf_dir)

    @cached_property
    def supply_plan(self) -> DataFrame:
        return testdata.supply_plan_network(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return testdata.products(self.spark, self.sf_dir)

    @cached_property
    def branches(self) -> DataFrame:
        return testdata.branches(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)
