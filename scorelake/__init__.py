"""scorelake — career-scorecard analytics on Spark.

Raw per-player career scorecards (three roles x three match formats) are
landed in a Parquet lake, cleaned with native column expressions, rolled up
into layered aggregate tables and served through parameterised queries that
return lazy DataFrames.
"""

from scorelake.specs import FORMATS, ROLES

__all__ = ["FORMATS", "ROLES"]
