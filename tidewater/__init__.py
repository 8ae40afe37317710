"""tidewater: change-data-capture operators on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function, so the same code
runs in batch jobs, inside Structured Streaming ``foreachBatch`` and in tests.
"""

__version__ = "0.1.0"
