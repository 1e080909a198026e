"""logweave: log labelling, template mining and log-anomaly detection on Spark.

Everything is expressed as DataFrame / SQL / Structured Streaming operations;
Python runs in executors only for the greedy template clusterer (grouped by
leaf) and the optional least-squares forecaster (grouped by event key).
"""

__version__ = "0.1.0"
