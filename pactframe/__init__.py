"""Contract pricing tables as Spark jobs.

Every public function takes and returns DataFrames or Columns. Python runs on
executors only in the two pluggable steps (analyze a file, answer a request)
and in the per-document text writer.
"""

__version__ = "0.1.0"
