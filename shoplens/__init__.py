"""shoplens: real-time retail analytics (daily actives, order value, coupon-abuse
alerts, sale-detail search) expressed as Spark DataFrame plans.

Sub-packages:
  sources    - record schemas, driver-table mappings, JSON/file/topic sources, keyed sinks
  functions  - column-level helpers (time text, decoding, tokens, shares)
  operators  - batch operators (dedup, GMV, alerts, joins, search)
  plans      - user-level queries (totals, hourly curves, sale-detail search)
  streaming  - Structured Streaming jobs built from the same operators
"""

from shoplens.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
