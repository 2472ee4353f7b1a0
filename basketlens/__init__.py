"""Commerce analytics as Spark DataFrame operators.

Layers, from raw data to decisions::

    sources    readers, layers (databases and parquet folders), sample data, registry
    functions  column expressions and distributed ranking helpers
    operators  one function per mart, model step, metric, check or report
    plans      end-to-end flows and the catalogue of checked queries
    streaming  request scoring over a stream
"""

__version__ = "0.1.0"
