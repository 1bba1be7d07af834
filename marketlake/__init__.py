"""marketlake — a PySpark-native medallion warehouse for order-and-marketplace data.

Layers are plain functions ``DataFrame(s) -> DataFrame``:

* :mod:`marketlake.sources`   — readers, writers, schemas, calendar, driver-table bindings
* :mod:`marketlake.functions` — column expressions (cleaning, date math, exact rounding)
* :mod:`marketlake.operators` — reusable DataFrame operators (dedupe, global rank,
  data-quality rules, statistics, time-series windows, top-k)
* :mod:`marketlake.plans`     — silver tables, gold star schema, marts, ad-hoc
  queries, notebook analytics, ML jobs and the layer pipeline
* :mod:`marketlake.streaming` — intentionally empty (the source warehouse is batch only)
"""

__version__ = "0.1.0"
