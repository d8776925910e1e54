"""evseq: ordered event-sequence analytics on Spark DataFrames.

Operators are plain functions ``DataFrame -> DataFrame`` that take column names
as arguments.  See README.md for the operator map.
"""

__version__ = "0.1.0"
