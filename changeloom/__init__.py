"""changeloom: analytics over database change streams, on PySpark.

Every operator is a function from DataFrame to DataFrame.  See README.md for a tour.
"""

__version__ = "0.1.0"
