"""stratum — layered (Bronze / Silver / Gold) table operators on PySpark.

Model code is ``DataFrame -> DataFrame`` (``operators``); reading lives in
``sources``, writing and job order in ``plans``, stream ingest in
``streaming`` and reusable ``Column -> Column`` rules in ``functions``.
"""

__version__ = "0.1.0"
