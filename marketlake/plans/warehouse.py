"""A lazily-built warehouse over one input location.

Each layer is built once per (session, input) and shared by every query that
needs it, the way a scheduled job would read the already-written layer. What
several tables or readers need is written to the shared folder when it is first
asked for: the silver orders of the gold layer, its silver items with the keys
of their orders, the payments per order, the order fact and (for readers of
``order_item_sk``) the numbered item lines. The other frames stay lazy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.numbering import staged
from marketlake.plans import gold as G
from marketlake.plans import marts as M
from marketlake.plans import silver as S
from marketlake.sources import bindings as B
from marketlake.sources.lake import Lake


#: Columns that the item lines carry beside those of the item fact.
CARRIED = ("is_repeat_customer", "product_category_name")


def to_output(df: DataFrame) -> DataFrame:
    """Decimals -> double for comparison/export; everything else unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, gold_params: G.GoldParams | None = None,
                 mart_params: M.MartParams = M.MartParams()):
        self.spark, self.sf_dir = spark, sf_dir
        self.mp = mart_params
        if gold_params:
            self.gp = gold_params

    @cached_property
    def gp(self) -> G.GoldParams:
        """Thresholds and the calendar, which spans the years of the data unless given."""
        return G.calendar_params(self.bronze["orders"], self.bronze["order_items"])

    def table(self, name: str) -> DataFrame:
        return B.load(self.spark, self.sf_dir, name)

    # bronze / silver ------------------------------------------------------
    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        return B.bronze(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return S.build_silver(self.bronze)

    # gold -----------------------------------------------------------------
    @cached_property
    def kept_orders(self) -> DataFrame:
        """The silver orders, written: four gold tables read them."""
        return staged(self.silver["orders"], "silver-orders")

    @cached_property
    def kept_items(self) -> DataFrame:
        """The columns of the silver items that the gold tables read, written; :attr:`met_items`, if they are there."""
        if "met_items" in self.__dict__:
            return self.met_items
        items = self.silver["order_items"]
        return staged(items.select([c for c in items.columns if c != "total_item_value"]), "silver-items")

    @cached_property
    def pay_totals(self) -> DataFrame:
        """The payments per order, written."""
        return staged(G.payment_totals(self.silver["order_payments"]).select("order_id", "total_payment_amount"), "payments")

    @cached_property
    def dim_date(self) -> DataFrame:
        return G.dim_date(self.spark, self.gp)

    @cached_property
    def dim_customer(self) -> DataFrame:
        s = self.silver
        return G.dim_customer(s["customers"], self.kept_orders, s["order_payments"], self.gp, self.pay_totals)

    @cached_property
    def order_keys(self) -> DataFrame:
        return G.order_keys(self.kept_orders, self.silver["customers"], self.dim_customer, self.dim_date)

    @cached_property
    def met_items(self) -> DataFrame:
        """The silver items with the purchase time and the keys of their orders, written: seller
        dimension, order fact and item lines read them."""
        keys = self.order_keys.join(self.dim_customer.select("customer_sk", "is_repeat_customer"), "customer_sk")
        met = staged(G.keyed_orders(self.kept_orders, keys, CARRIED), "keyed-orders")
        return staged(G.met_items(S.valid_items(self.bronze["order_items"]), met), "silver-items")

    @cached_property
    def fact_orders(self) -> DataFrame:
        s = self.silver
        return staged(G.fact_orders(self.kept_orders, self.met_items, s["order_payments"], s["order_reviews"], self.order_keys, self.pay_totals), "fact-orders")

    @cached_property
    def dim_product(self) -> DataFrame:
        return G.dim_product(self.silver["products"], self.silver["category_translation"])

    @cached_property
    def keyed_sellers(self) -> DataFrame:
        """``seller_sk`` and the master data of the sellers, for readers of no sales metrics."""
        return G.keyed_sellers(self.silver["sellers"])

    @cached_property
    def dim_seller(self) -> DataFrame:
        return staged(G.dim_seller(self.keyed_sellers, self.kept_items, self.kept_orders, self.gp), "dim-seller")

    def _lines(self, number: bool) -> DataFrame:
        return G.fact_order_items(self.met_items, self.order_keys, self.dim_product, self.keyed_sellers, self.dim_date, self.gp, CARRIED, number)

    @cached_property
    def item_lines(self) -> DataFrame:
        """The item fact with the buyer's repeat flag and the product category, which
        :attr:`item_base` needs: the orders and the products meet the lines once."""
        return self._lines(True)

    @property
    def plain_lines(self) -> DataFrame:
        """:attr:`item_lines` for readers of everything but ``order_item_sk``: a number that nobody reads
        is no reason to sort and write all lines. Where they are written, these are read."""
        return self.item_lines.drop("order_item_sk") if "item_lines" in self.__dict__ else self._lines(False)

    @property
    def plain_fact_items(self) -> DataFrame:
        """:attr:`fact_order_items` without ``order_item_sk``."""
        return self.plain_lines.drop(*CARRIED)

    @property
    def plain_item_base(self) -> DataFrame:
        """:attr:`item_base` without ``order_item_sk``."""
        return M.item_order_base(self.plain_lines, self.fact_orders, self.dim_customer, self.dim_product)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return self.item_lines.drop(*CARRIED)

    @cached_property
    def item_base(self) -> DataFrame:
        return M.item_order_base(self.item_lines, self.fact_orders, self.dim_customer, self.dim_product)

    @cached_property
    def seller_totals(self) -> DataFrame:
        return M.seller_totals(self.item_base)

    # marts ----------------------------------------------------------------
    @cached_property
    def customer_rfm(self) -> DataFrame:
        return M.customer_rfm(self.fact_orders, self.dim_date, p=self.mp)

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return M.cohort_retention(self.fact_orders, self.dim_date)

    @cached_property
    def seller_performance(self) -> DataFrame:
        return M.seller_performance(self.seller_totals, self.mp)

    @cached_property
    def product_sales(self) -> DataFrame:
        return staged(M.product_sales(self.plain_fact_items, self.fact_orders, self.dim_product, self.mp,
                                      base=self.plain_item_base), "product-sales")

    @cached_property
    def delivery_performance(self) -> DataFrame:
        return M.delivery_performance(self.seller_totals, self.mp)

    @cached_property
    def executive_kpi(self) -> DataFrame:
        return M.executive_kpi(self.fact_orders, self.dim_date, self.dim_customer)

    @cached_property
    def monthly_business_summary(self) -> DataFrame:
        return M.monthly_business_summary(self.fact_orders, self.dim_date, self.dim_customer)

    @cached_property
    def category_dashboard(self) -> DataFrame:
        return M.category_dashboard(self.product_sales)

    @cached_property
    def customer_360(self) -> DataFrame:
        return M.customer_360(self.dim_customer, self.fact_orders, self.customer_rfm,
                              self.plain_fact_items, self.dim_product, base=self.plain_item_base)


class LayerWarehouse(Warehouse):
    """A warehouse whose silver, gold and mart tables are the current versions of the lake that
    :func:`marketlake.plans.pipeline.run_layers` published (bronze stays bound to
    ``sf_dir``). Queries then start from the materialised layers."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, **kw):
        super().__init__(spark, sf_dir, **kw)
        self.lake = Lake(spark, root)
        self.state = self.lake.manifest()  # one state for all tables, whatever is published later

    def _one(self, name: str) -> DataFrame:
        return self.lake.frame(name, self.state[name]).drop("dwh_create_date", "created_at")  # load audit, never compared

    def _read(self, name: str) -> DataFrame:
        return self._one(name).union(self._one(f"{name}_hot")) if f"{name}_hot" in self.state else self._one(name)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {n: self._read(f"silver/{n}") for n in S.SILVER_JOBS}

    dim_date = cached_property(lambda self: self._read("gold/dim_date"))
    dim_customer = cached_property(lambda self: self._read("gold/dim_customer"))
    order_keys = cached_property(lambda self: self._read("gold/order_keys"))
    fact_orders = cached_property(lambda self: self._read("gold/fact_orders"))
    dim_product = cached_property(lambda self: self._read("gold/dim_product"))
    dim_seller = cached_property(lambda self: self._read("gold/dim_seller"))
    keyed_sellers = cached_property(lambda self: self.dim_seller)
    fact_order_items = cached_property(lambda self: self._read("gold/fact_order_items"))
    item_base = cached_property(lambda self: self._read("gold/item_order_base"))
    plain_fact_items = property(lambda self: self.fact_order_items.drop("order_item_sk"))
    plain_item_base = property(lambda self: self.item_base.drop("order_item_sk"))
    customer_rfm = cached_property(lambda self: self._read("marts/customer_rfm"))
    cohort_retention = cached_property(lambda self: self._read("marts/cohort_retention"))
    seller_performance = cached_property(lambda self: self._read("marts/seller_performance_mart"))
    product_sales = cached_property(lambda self: self._read("marts/product_sales_mart"))
    delivery_performance = cached_property(
        lambda self: self._read("marts/delivery_performance_mart"))
    executive_kpi = cached_property(lambda self: self._read("marts/executive_kpi_mart"))
    monthly_business_summary = cached_property(
        lambda self: self._read("marts/monthly_business_summary"))
    category_dashboard = cached_property(lambda self: self._read("marts/category_dashboard_mart"))
    customer_360 = cached_property(lambda self: self._read("marts/customer_360_mart"))


_CACHE: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The shared lazy warehouse over ``sf_dir``. The session's settings are left alone; a job
    that wants its shuffle partitions sized calls :func:`marketlake.session.size_shuffle_partitions`."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Warehouse(spark, sf_dir)
    return _CACHE[key]
