"""textloom: text-corpus preparation as ordinary Spark DataFrame plans.

Operators are plain functions ``DataFrame -> DataFrame`` or ``Column -> Column``
(usable with ``df.transform``).  Nothing here keeps state outside Spark.
"""

__version__ = "0.1.0"
