"""Star-schema preparation on Spark: land, clean, conform, publish, check, summarise.

Every operator takes and returns DataFrames (or Columns), holds no state and needs no session of its own.
"""
