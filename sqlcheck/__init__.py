"""Independent SQL statements of every registered query, for the DuckDB oracle.

The SQL follows the warehouse's own statement structure (CTE chains,
``ROW_NUMBER() OVER (ORDER BY ...)`` keys, ``SELECT DISTINCT`` dedupe), not
the Spark plans, so that a mismatch points at a real semantic difference.
"""
