"""tillscope: retail star-schema analytics as Spark DataFrame plans.

Sub-packages
------------
sources    schemas, star loading/writing, calendar and channel dimensions,
           the mapping from the driver's TPC-H-like tables onto the star
functions  column-level helpers (status filter, exact rounding, labels)
operators  reusable distributed operators (NTILE, top-k, basket pairs,
           pivot, audits, order financials, idempotent insert)
plans      the named analytics: views, example queries, notebook frames,
           k-means segments
streaming  incremental (micro-batch) load of the fact tables
"""

from tillscope.sources.star import Star, load_star, write_star, register_views, run_query  # noqa: F401
