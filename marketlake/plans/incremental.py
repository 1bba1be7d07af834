"""Incremental refresh of the KPI marts (SRC-9): loads in slices, marts from mergeable partials.

A refresh takes the order rows whose audit time is after the last load's and reduces them to
partial aggregates that merge by addition: one row per day and customer (delivered orders, their
value, review sum and delays) and one per customer (orders of any status). A day's customers are
kept as rows, sorted in their files, so distinct counts stay exact for any union of days and loads.

Partials are written into partitions of their load and month with dynamic partition overwrite, and
the load is entered in the control table last. A refresh that dies before that is taken again from
the same audit times and replaces the same partitions: nothing is counted twice.

Orders are only added: an order is in one load. An audit time belongs to one load as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import dates as D
from marketlake.plans import marts as M

_DAILY = "customer_sk long, n long, gmv decimal(28,2), review double, delayed long, date_sk int, full_date date, load string, month string"
_PEOPLE = "customer_sk long, n long, load string"
_LOADS = "load string, from_time timestamp, to_time timestamp, n_rows long"


@dataclass
class KpiState:
    """Partials and control table under ``root`` (shared storage)."""
    spark: SparkSession
    root: str

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}") if there else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, name: str, *parts: str) -> None:
        # few files a partition, more where it is large; in a file the customers lie in order
        df.hint("rebalance", *parts).sortWithinPartitions(*parts, "customer_sk") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{self.root}/{name}")

    def loads(self) -> DataFrame:
        """The control table: (load, from_time, to_time, n_rows) of every finished load."""
        return self._read("loads", _LOADS)

    def refresh(self, orders: DataFrame, audit: str = "dwh_create_date") -> int:
        """Take the rows of ``orders`` (the order fact with its audit time) that are new; their number."""
        since = self.loads().agg(F.max("to_time")).first()[0]
        new = orders if since is None else orders.where(F.col(audit) > F.lit(since))
        span = new.agg(F.count(F.lit(1)).alias("n"), F.min(audit).alias("a"), F.max(audit).alias("b")).first()
        if not span["n"]:
            return 0
        # rows that come in while this runs are the next load's
        new = new.where(F.col(audit) <= F.lit(span["b"]))
        load = F.lit(f"{span['b']:%Y%m%dT%H%M%S%f}")
        delivered = new.where("order_status = 'delivered'").withColumn("date_sk", F.col("purchase_date_sk")).withColumn("full_date", D.date_from_key("date_sk"))
        daily = delivered.groupBy("customer_sk", "date_sk", "full_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("total_payment_amount").cast("decimal(28,2)").alias("gmv"),
            F.sum("avg_review_score").alias("review"), F.sum("is_delayed").cast("long").alias("delayed"))
        self._write(daily.select("customer_sk", "n", "gmv", "review", "delayed", "date_sk", "full_date", load.alias("load"), D.year_month("full_date").alias("month")), "daily", "load", "month")
        people = new.groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"))
        self._write(people.select("customer_sk", "n", load.alias("load")), "people", "load")
        done = self.spark.createDataFrame([(span["a"], span["b"], span["n"])], "from_time timestamp, to_time timestamp, n_rows long")
        done.select(load.alias("load"), "from_time", "to_time", "n_rows").coalesce(1).write.mode("append").parquet(f"{self.root}/loads")
        return span["n"]

    def _finished(self, name: str, schema: str) -> DataFrame:
        """Partials of the loads in the control table (one row a load)."""
        return self._read(name, schema).join(self.loads().select("load"), "load", "left_semi")

    def _per_customer(self, *period) -> DataFrame:
        daily = self._finished("daily", _DAILY)
        people = self._finished("people", _PEOPLE).groupBy("customer_sk").agg((F.sum("n") > 1).cast("int").alias("_rep"))
        sums = daily.groupBy(*period, "customer_sk").agg(
            F.max("full_date").alias("_fd"), F.sum("n").alias("_n"), F.sum("gmv").alias("_gmv"), F.sum("review").alias("_review"), F.sum("delayed").alias("_delayed"))
        return sums.join(people, "customer_sk")

    def executive_kpi(self) -> DataFrame:
        """MRT-6 from the partials."""
        return M.daily_kpis(M.by_period(self._per_customer("date_sk"), "date_sk"))

    def monthly_business_summary(self) -> DataFrame:
        """MRT-7 from the partials."""
        return M.monthly_kpis(M.by_period(self._per_customer(D.year_month("full_date").alias("year_month")), "year_month"))
