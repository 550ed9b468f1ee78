"""Event-time analytics on Spark: plain DataFrame -> DataFrame operators.

Every operator takes a batch or a streaming DataFrame and declares its work with
the DataFrame API. Only sources, sinks, triggers and watermarks know whether the
data is bounded.
"""
