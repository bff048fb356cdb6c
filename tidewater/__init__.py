"""tidewater: change-stream and text-stream analytics on PySpark.

Every operator is a DataFrame -> DataFrame function (or a Column builder) that
works the same way on a batch DataFrame and inside ``foreachBatch`` of a
Structured Streaming query.
"""

__version__ = "0.1.0"
