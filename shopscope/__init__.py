"""Retail revenue and retention analytics as Spark DataFrame jobs.

Layout:
  sources/    readers for the input tables, the raw-sales view, sinks
  functions/  Column helpers (exact decimal ratios, calendar math, p-values)
  plans/      multi-stage plans: skew-safe global ordering, star-schema build
  operators/  the analytical operators (audit, cleaning, RFM, cohorts, ...)

Every operator is a plain ``DataFrame -> DataFrame`` function.
"""

__all__ = ["session"]
