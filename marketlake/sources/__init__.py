"""Sources and sinks.

* :mod:`schemas`  — explicit bronze schemas and export layouts
* :mod:`files`    — CSV / TSV / Parquet / JDBC readers and writers, header
  normalisation, audit column
* :mod:`calendar` — calendar generator and date-dimension attributes
* :mod:`bindings` — the driver's TPC-H-like tables bound to bronze-shaped inputs
"""
