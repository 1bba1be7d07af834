"""Load contracts (SRC-8): what a table must look like, checked in the pass that loads it.

A contract declares the columns with their types, which of them are required, the key, and value
rules. :meth:`Contract.mark` selects the declared columns by name, casts them, and lists for each
row the rules it breaks: ``type:c`` (a value that does not fit the type), ``null:c`` (required)
and the named rules (a condition that is false; NULL passes, as in a SQL CHECK). Extra columns are
left out, a missing column is an error. ``key`` rows that repeat break ``key``, all but the
smallest of them; that check is one aggregate over the key columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.numbering import staged
from marketlake.sources import schemas as SC

RULES = "_broken_rules"


@dataclass(frozen=True)
class Contract:
    columns: T.StructType
    required: tuple[str, ...] = ()
    rules: tuple[tuple[str, str], ...] = ()  # name, SQL condition that must hold
    key: tuple[str, ...] = ()  # checked for repeats if given

    def names(self) -> list[str]:
        return [*(f"type:{f.name}" for f in self.columns), *(f"null:{c}" for c in self.required), *(n for n, _ in self.rules), *(["key"] if self.key else [])]

    def mark(self, df: DataFrame) -> DataFrame:
        """The declared columns of ``df``, cast, with the rules each row breaks in ``RULES``."""
        missing = [f.name for f in self.columns if f.name not in df.columns]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
        kinds, broken = {f.name: f.dataType for f in df.schema}, []
        cast: dict[str, Column] = {}
        for f in self.columns:
            same = kinds[f.name] == f.dataType
            cast[f.name] = F.col(f.name) if same else F.col(f.name).try_cast(f.dataType)
            if not same:
                broken.append(F.when(F.col(f.name).isNotNull() & cast[f.name].isNull(), F.lit(f"type:{f.name}")))
        typed = df.select(*[c.alias(n) for n, c in cast.items()], F.array_compact(F.array(*broken)).cast("array<string>").alias("_types"))
        tests = [F.when(F.col(c).isNull() & ~F.array_contains("_types", f"type:{c}"), F.lit(f"null:{c}")) for c in self.required]
        tests += [F.when(~F.expr(condition), F.lit(name)) for name, condition in self.rules]
        named = F.array_compact(F.array(*tests)).cast("array<string>")
        return self._with_key(typed.withColumn(RULES, F.concat("_types", named)).drop("_types"))

    def _with_key(self, marked: DataFrame) -> DataFrame:
        if not self.key:
            return marked
        again = marked.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        if again.isEmpty():
            return marked
        # rows of repeated keys are written aside and numbered: the smallest stays, one of equal ones
        again = staged(again.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)]), "repeated-keys")
        same = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(c)) for i, c in enumerate(self.key)])
        aside = staged(marked.join(again, same, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "repeated-rows")
        full = F.struct(*self.columns.fieldNames(), "_row")
        first = aside.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)]).agg(F.min(full).alias("_first"))
        judged = aside.join(first, same).withColumn(RULES, F.when(full != F.col("_first"), F.array_append(RULES, F.lit("key"))).otherwise(F.col(RULES)))
        return marked.join(again, same, "left_anti").union(judged.select(*marked.columns))


def rejects(df: DataFrame, contract: Contract, table: str) -> DataFrame:
    """A row (table_name, rule, n_rows, n_bad) for each rule of the contract, from one pass."""
    marked = contract.mark(df)
    counts = marked.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.array_contains(RULES, n)).alias(f"_{i}") for i, n in enumerate(contract.names())])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("n_bad")) for i, n in enumerate(contract.names())]))
    return counts.select(F.lit(table).alias("table_name"), "n_rows", rows).select("table_name", "rule", "n_rows", "n_bad")


_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}


def columns(text: str) -> T.StructType:
    """"a string, b decimal(18,2)" as a schema."""
    fields = [c.split() for c in re.split(r",\s+", text.strip())]
    kind = lambda t: T.DecimalType(*map(int, re.findall(r"\d+", t))) if t.startswith("decimal") else _KINDS[t]
    return T.StructType([T.StructField(n, kind(t), True) for n, t in fields])


def _table(schema: str | T.StructType, required: str = "", rules: dict[str, str] | None = None, key: str = "") -> Contract:
    schema = columns(schema) if isinstance(schema, str) else schema
    return Contract(schema, tuple(required.split()), tuple((rules or {}).items()), tuple(key.split()))


#: What the source files must hold (SRC-1): types of the bronze schemas, ids and plausible values.
BRONZE = {
    "customers": _table(SC.BRONZE["customers"], "customer_id customer_unique_id"),
    "geolocation": _table(SC.BRONZE["geolocation"], "geolocation_zip_code_prefix",
                          {"latitude": "geolocation_lat BETWEEN -90 AND 90", "longitude": "geolocation_lng BETWEEN -180 AND 180"}),
    "order_items": _table(SC.BRONZE["order_items"], "order_id order_item_id product_id seller_id", {"price": "price >= 0", "freight": "freight_value >= 0"}),
    "order_payments": _table(SC.BRONZE["order_payments"], "order_id payment_type", {"value": "payment_value >= 0", "sequence": "payment_sequential >= 1"}),
    "order_reviews": _table(SC.BRONZE["order_reviews"], "review_id order_id", {"score": "review_score BETWEEN 1 AND 5",
                                                                               "answered": "review_answer_timestamp >= review_creation_date"}),
    "orders": _table(SC.BRONZE["orders"], "order_id customer_id order_status order_purchase_timestamp",
                     {"approved": "order_approved_at >= order_purchase_timestamp", "delivered": "order_delivered_customer_date >= order_purchase_timestamp"}),
    "products": _table(SC.BRONZE["products"], "product_id product_category_name", {"weight": "product_weight_g >= 0", "name length": "product_name_lenght >= 0"}),
    "sellers": _table(SC.BRONZE["sellers"], "seller_id", {"zip": "seller_zip_code_prefix BETWEEN '1000' AND '99999'"}),
    "category_translation": _table(SC.BRONZE["category_translation"], "product_category_name product_category_name_english"),
}
