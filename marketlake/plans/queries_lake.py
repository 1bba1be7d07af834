"""Registered queries over loads: contracts, metrics of a load, incremental marts (SRC-5..9, DQ-13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlake.plans import silver as S
from marketlake.plans.contracts import CONTRACTS
from marketlake.plans.gold import off_calendar
from marketlake.plans.incremental import KpiState
from marketlake.plans.registry import register
from marketlake.session import ensure_checkpoint_dir
from marketlake.sources import contracts as C
from marketlake.sources.calendar import calendar
from marketlake.sources.lake import Lake
from sqlcheck.fragments import compose


def _fresh(w, name: str) -> str:
    return f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def _rule_counts(contract: C.Contract, table: str, source: str, head: str) -> list[str]:
    """SQL counts of a contract's rules over a table that has the declared types."""
    bad = {f"type:{f.name}": "false" for f in contract.columns}
    bad |= {f"null:{c}": f"{c} IS NULL" for c in contract.required}
    bad |= {name: f"NOT ({condition})" for name, condition in contract.rules}
    if contract.key:
        bad["key"] = f"row_number() OVER (PARTITION BY {', '.join(contract.key)}) > 1"
    return [f"SELECT {head}'{table}' AS table_name, '{name}' AS rule, count(*) AS n_rows, count_if(b) AS n_bad FROM (SELECT {test} AS b FROM {source}) t"
            for name, test in bad.items()]


@register("src_load_rejects", compose("\nUNION ALL\n".join(
    sql for t, c in C.BRONZE.items() for sql in _rule_counts(c, t, f"b_{t}", ""))))
def src_load_rejects(w):
    """SRC-8: rows of the nine sources that their load contracts turn away, by rule."""
    out = None
    for name, contract in C.BRONZE.items():
        part = C.rejects(w.bronze[name], contract, name)
        out = part if out is None else out.unionByName(part)
    return out


_HISTORY_SQL = [sql for t, c in C.BRONZE.items() for sql in _rule_counts(c, t, f"b_{t}", "'bronze' AS layer, ")] + \
    [sql for t in S.SILVER_JOBS for sql in _rule_counts(CONTRACTS[f"silver/{t}"], t, f"s_{t}", "'silver' AS layer, ")]


@register("dq_load_metrics", compose("\nUNION ALL\n".join(_HISTORY_SQL)))
def dq_load_metrics(w):
    """DQ-13: all rules of the nine tables, before and after the silver load, gathered by the loads
    themselves (one job a table, no second scan) and read back from the lake's history."""
    lake = Lake(w.spark, _fresh(w, "metrics"))
    for name, contract in C.BRONZE.items():
        lake.load(f"bronze/{name}", w.bronze[name], contract)
    for name in S.SILVER_JOBS:
        lake.load(f"silver/{name}", w.silver[name], CONTRACTS[f"silver/{name}"])
    lake.publish()
    return lake.quality_history().select("layer", "table_name", "rule", "n_rows", "n_bad")


_CALENDARS = ("data", "2016-2020")
_DATED = (("orders", "order_purchase_timestamp"), ("order_items", "shipping_limit_date"))


@register("dq_off_calendar", compose("\nUNION ALL\n".join(
    f"SELECT '{name}' AS calendar, '{t}' AS table_name, count(*) AS n_rows, count_if({c}::DATE IS NULL OR NOT ({test.format(c=c)})) AS n_off FROM s_{t}"
    for t, c in _DATED for name, test in zip(_CALENDARS, ("{c}::DATE IN (SELECT full_date FROM g_dim_date)", "year({c}) BETWEEN 2016 AND 2020")))))
def dq_off_calendar(w):
    """JN-6: orders and items that the inner join with the calendar drops: with the years of the data
    (none) and with the warehouse's own calendar."""
    out = None
    for t, c in _DATED:
        for name, days in zip(_CALENDARS, (w.dim_date, calendar(w.spark))):
            part = off_calendar(w.silver[t], c, days, t).select(F.lit(name).alias("calendar"), "*")
            out = part if out is None else out.unionByName(part)
    return out


def _three_loads(w) -> KpiState:
    """The orders of the fact in three loads, each with a third of every day's orders."""
    state = KpiState(w.spark, _fresh(w, "kpi"))
    orders = w.fact_orders.select("order_id", "customer_sk", "purchase_date_sk", "order_status", "total_payment_amount", "avg_review_score", "is_delayed")
    part = F.pmod(F.crc32(F.col("order_id").cast("binary")), F.lit(3))
    for k in range(3):
        came = orders.where(part <= k).withColumn("dwh_create_date", F.timestamp_add("DAY", part.cast("int"), F.lit("2024-01-01 06:00:00").cast("timestamp")))
        state.refresh(came)  # the source holds what came so far; earlier rows are not taken again
    return state


@register("inc_executive_kpi", compose("SELECT * FROM m_executive_kpi"))
def inc_executive_kpi(w):
    """SRC-9: the daily KPI mart after three incremental loads equals the one of a full load."""
    return _three_loads(w).executive_kpi()


@register("inc_monthly_business_summary", compose("SELECT * FROM m_monthly_business_summary"))
def inc_monthly_business_summary(w):
    """SRC-9: the monthly mart after three incremental loads equals the one of a full load."""
    return _three_loads(w).monthly_business_summary()
