"""fieldmart: Spark operators and report tables for a field-service operation.

Every public function takes and returns DataFrames or Columns, stays lazy, and gets
its notion of "now" through an explicit ``as_of`` argument.
"""

__version__ = "0.1.0"
