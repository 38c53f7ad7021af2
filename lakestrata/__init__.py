"""lakestrata: layered lakehouse analytics as plain Spark DataFrame functions.

Three flows, each a set of ``DataFrame -> DataFrame`` operators on Spark
built-ins:

* films medallion  -- raw JSON -> bronze -> deduplicated, typed silver -> gold
* job postings     -- landed pages -> flat rows -> window / dedup / insert-if-new
                      with a versioned control table (batch and streaming)
* weather          -- parallel-array responses -> daily rows, as-of hourly picks,
                      partitioned sinks, month calendar and load report

I/O lives in ``lakestrata.sources`` and ``lakestrata.streaming``; the rest is
pure and lazy.
"""

__all__ = ["session", "config", "schemas"]
