"""feedledger: DataFrame operators over a catalog of periodic data files.

Sub-packages:
  functions  -- column expressions (name parsing, globs, text and date formats, backoff)
  sources    -- readers and writers (catalog tables, directory listings, record files, sinks)
  operators  -- DataFrame -> DataFrame operators (catalog, policy, stages, scan, jobs, ...)
  plans      -- composed jobs (list spec, scan merge, conversion, dashboard) and the query registry
  streaming  -- Structured Streaming jobs built from the same operators
"""

__version__ = "0.1.0"
