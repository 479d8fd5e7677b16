"""answercheck: is the answer a query gives right? Checked on Spark, at scale.

Subpackages:
  sources    the driver's tables, the shop ruling, the suite and its candidates
  operators  relational questions, fan-out, data quality, metrics, result diff, scoring
  functions  column functions over text (case, money, squash, fences, similarity)
  plans      running SQL as data, the governed read-only session, the catalog
  streaming  nothing: the reference has no streams (see its module docstring)
"""

__all__ = ["session", "registry"]
