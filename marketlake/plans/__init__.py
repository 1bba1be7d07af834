"""Jobs built from the operators.

* :mod:`silver`, :mod:`gold`, :mod:`marts` — the warehouse layers
* :mod:`ml` — pyspark.ml jobs and metrics
* :mod:`pipeline` — writes every layer to Parquet (``run_layers``)
* :mod:`warehouse` — lazily built warehouse per input, or one read from written layers
* :mod:`registry`, :mod:`catalog`, ``queries_*`` — the registered queries
"""
