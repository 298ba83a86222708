"""civicmart: Spark-native table operators and batch jobs for municipal reporting data.

Every operator is a ``Column -> Column`` expression (``civicmart.functions``) or a
``DataFrame -> DataFrame`` transformation (``civicmart.operators``), composed into whole
jobs in ``civicmart.plans``. Nothing runs row by row in Python: Catalyst plans all of it.
"""

__version__ = "0.1.0"
