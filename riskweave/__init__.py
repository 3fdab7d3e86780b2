"""riskweave: loan-risk feature, selection and scoring operators on PySpark.

Everything is expressed with the DataFrame / SQL API, ``pyspark.ml`` and
Structured Streaming; no Python row UDF sits in a hot path.
"""

__version__ = "0.1.0"
