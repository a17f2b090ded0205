"""strata: a Spark-native medallion lakehouse for sales, order and shipment data.

Every operator is a plain function from DataFrame(s) to a DataFrame built on
the public DataFrame / SQL / Structured Streaming / MLlib APIs.  Nothing in
here counts, collects or prints; actions happen only in the plans that
materialise tables and in the callers.
"""

__version__ = "0.1.0"
