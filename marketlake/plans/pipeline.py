"""Layer pipeline (SRC-13): bronze -> silver -> gold -> marts, loaded into a lake of named tables.

Each table is loaded as a new version beside the old one (:mod:`marketlake.sources.lake`), checked
against its contract in the pass that writes it, and read back by the layers after it, so every
layer starts from files (short lineage: a lost executor recomputes from the last written table, not
from the raw inputs). One publish at the end moves all tables to the new versions together; a run
that dies leaves the old ones in place. The root must be shared storage on a cluster; by default it
is a fresh folder under the session's ``spark.checkpoint.dir``.

One layout at all sizes: what belongs to an order lies in buckets of ``order_id``, one file and one
task a bucket, so the joins and aggregates of the order and item facts move nothing. An order that
would fill much of a bucket by itself keeps its lines apart (``*_hot`` tables, in plain files): at
most four such orders a bucket can exist, so what they need is broadcast.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import gold as G
from marketlake.plans import marts as M
from marketlake.plans import silver as S
from marketlake.plans.contracts import CONTRACTS
from marketlake.session import ensure_checkpoint_dir, input_bytes, size_shuffle_partitions
from marketlake.sources import bindings as B
from marketlake.sources.lake import Lake


def default_output(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/layers-{uuid.uuid4().hex[:8]}"


# Load-time audit column per table (SRC-9): the warehouse's default name, a
# different name on the customer-360 mart, none on the order fact.
AUDIT_COLUMN = {"gold/fact_orders": None, "marts/customer_360_mart": "created_at"}
AUDIT_COLUMNS = ("dwh_create_date", "created_at")
#: Tables in buckets of order_id.
BY_ORDER = ("silver/orders", "silver/order_items", "silver/order_payments", "silver/order_reviews",
            "gold/order_keys", "gold/fact_orders", "gold/fact_order_items", "gold/item_order_base")
#: Tables whose hot orders lie apart, under the name with "_hot".
WITH_HOT = ("silver/order_items", "gold/fact_order_items", "gold/item_order_base")


def run_layers(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
               gp: G.GoldParams | None = None, mp: M.MartParams = M.MartParams(),
               bronze: dict[str, DataFrame] | None = None,
               buckets: int | None = None, parallel_tables: int = 6, size_partitions: bool = True) -> dict:
    """Load every silver, gold and mart table and publish them; returns ``{"root": path,
    "timings": {...}, "lake": the :class:`Lake`, "manifest": number of the published state}``.

    ``bronze`` defaults to the driver-table bindings under ``sf_dir``; pass
    frames from :func:`marketlake.sources.files.read_csv` for raw CSV inputs.
    ``buckets``: buckets of ``order_id``; None = the session's ``spark.sql.shuffle.partitions``.
    ``parallel_tables``: how many independent tables of one layer are built at
    once (1 = one after another).
    ``size_partitions``: with the driver-table bindings, first raise
    ``spark.sql.shuffle.partitions`` (and so the bucket count) from the bound
    tables' size on storage (:func:`marketlake.session.size_shuffle_partitions`).
    """
    lake = Lake(spark, out_dir or default_output(spark))
    if size_partitions and bronze is None and sf_dir:
        size_shuffle_partitions(spark, input_bytes(spark, B.bound_paths(sf_dir)))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    br = bronze or B.bronze(spark, sf_dir)
    gp = gp or G.calendar_params(br["orders"], br["order_items"])

    def put(name: str, df: DataFrame) -> DataFrame:
        by = "order_id" if name in BY_ORDER else None
        return lake.load(name, df, CONTRACTS.get(name.removesuffix("_hot")), AUDIT_COLUMN.get(name, "dwh_create_date"), by, buckets if by else None)

    def wave(jobs: dict) -> dict:
        """Load a set of mutually independent tables concurrently: each is its
        own Spark job, submitted from its own thread, sharing the executors."""
        if parallel_tables <= 1:
            return {name: put(name, make()) for name, make in jobs.items()}
        with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
            futures = {name: pool.submit(lambda n=name, m=make: put(n, m())) for name, make in jobs.items()}
            return {name: f.result() for name, f in futures.items()}

    for layer in ("silver", "gold", "marts", "versions"):
        lake.namespace(layer)
    # the orders with too many lines for a bucket, by the raw lines: a line more or less decides nothing
    hot_ids = lake.load("gold/hot_orders", G.hot_orders(br["order_items"].where("order_id is not null"), buckets))

    none_hot = hot_ids.isEmpty()

    def split(name: str, lines: DataFrame) -> dict:
        few = F.broadcast(hot_ids)  # 4 * buckets ids at most
        hot = spark.createDataFrame([], lines.schema) if none_hot else lines.join(few, "order_id", "left_semi").select(lines.columns)
        return {name: lambda: lines.join(few, "order_id", "left_anti").select(lines.columns), f"{name}_hot": lambda: hot}

    def lines_of(tables: dict, name: str) -> G.OrderLines:
        return G.OrderLines(tables[name], tables[f"{name}_hot"], hot_ids)

    jobs = {f"silver/{n}": (lambda f=f, n=n: f(br[n])) for n, f in S.SILVER_JOBS.items() if n != "order_items"}
    t = wave(split("silver/order_items", S.SILVER_JOBS["order_items"](br["order_items"])) | jobs | {"gold/dim_date": lambda: G.dim_date(spark, gp)})
    silver = {n: t[f"silver/{n}"] for n in S.SILVER_JOBS}
    items, dd = lines_of(t, "silver/order_items"), t["gold/dim_date"]

    t |= wave({
        "gold/dim_customer": lambda: G.dim_customer(silver["customers"], silver["orders"], silver["order_payments"], gp),
        "gold/dim_product": lambda: G.dim_product(silver["products"], silver["category_translation"]),
        "gold/dim_seller": lambda: G.dim_seller(silver["sellers"], items, silver["orders"], gp)})
    dc, dp, ds = t["gold/dim_customer"], t["gold/dim_product"], t["gold/dim_seller"]

    keys = put("gold/order_keys", G.order_keys(silver["orders"], silver["customers"], dc, dd))
    t |= wave({"gold/fact_orders": lambda: G.fact_orders(silver["orders"], items, silver["order_payments"], silver["order_reviews"], keys)}
              | split("gold/fact_order_items", G.fact_order_items(items, keys, dp, ds, dd, gp)))
    fo, foi = t["gold/fact_orders"], lines_of(t, "gold/fact_order_items")
    t |= wave(split("gold/item_order_base", M.item_order_base(foi, fo, dc, dp)))
    base = lines_of(t, "gold/item_order_base").all()
    sellers = put("gold/seller_totals", M.seller_totals(base))

    t |= wave({
        "marts/customer_rfm": lambda: M.customer_rfm(fo, dd, p=mp),
        "marts/cohort_retention": lambda: M.cohort_retention(fo, dd),
        "marts/seller_performance_mart": lambda: M.seller_performance(sellers, mp),
        "marts/product_sales_mart": lambda: M.product_sales(foi, fo, dp, mp, base=base),
        "marts/delivery_performance_mart": lambda: M.delivery_performance(sellers, mp),
        "marts/executive_kpi_mart": lambda: M.executive_kpi(fo, dd, dc),
        "marts/monthly_business_summary": lambda: M.monthly_business_summary(fo, dd, dc)})
    t |= wave({
        "marts/category_dashboard_mart": lambda: M.category_dashboard(t["marts/product_sales_mart"]),
        "marts/customer_360_mart": lambda: M.customer_360(dc, fo, t["marts/customer_rfm"], foi, dp, base=base)})
    return {"root": lake.root, "timings": lake.timings, "lake": lake, "manifest": lake.publish()}
