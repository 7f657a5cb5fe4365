"""idweave: trade-date security identifiers, built as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function. Compose them, or use
``idweave.plans`` for the assembled jobs.
"""

__version__ = "0.1.0"
