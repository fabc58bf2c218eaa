"""promptmill: fine-tuning data preparation and completion scoring on PySpark.

Every operator is either ``Column -> Column`` (``promptmill.functions``) or
``DataFrame -> DataFrame`` (``promptmill.operators``), so it can be used with
``df.transform`` in batch jobs and, where it keeps no state, on streams.
"""

__version__ = "0.1.0"
