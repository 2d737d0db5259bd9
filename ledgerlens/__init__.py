"""ledgerlens: retail revenue analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (feeds, tables, files), ``operators`` (cleaning,
quality, KPIs, trends, impact, customers/churn, projection/forecast,
reports), ``functions`` (column helpers), ``plans`` (batch job, query
catalog, oracle SQL) and ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
