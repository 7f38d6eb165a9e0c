"""mercato — a Spark-native retail warehouse and analytics package.

Layers (bronze → silver → gold), a catalogue of analytical queries, SQL table
functions, data-quality rules, serving tables, ML jobs and search, all written
as DataFrame / Spark SQL plans that run on executors.
"""

__version__ = "0.1.0"
