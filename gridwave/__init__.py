"""gridwave: disturbance-recording analytics as plain Spark DataFrame jobs.

Every public operator is a function ``DataFrame -> DataFrame`` (or a column
expression builder) so the same code serves batch and Structured Streaming.
"""

__version__ = "0.1.0"
