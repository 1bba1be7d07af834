"""Reusable DataFrame operators.

* :mod:`dedupe`  — exact-copy and key dedupe, majority value (aggregates over structs)
* :mod:`rank`    — distributed global row number / NTILE / surrogate keys
* :mod:`quality` — data-quality rules evaluated in one aggregate pass
* :mod:`stats`   — value counts, exact equal-width histogram, correlation matrix, pivot
* :mod:`series`  — per-series lags, rolling means, chronological split
* :mod:`topk`    — top-k, ranked top-k, tail
"""
