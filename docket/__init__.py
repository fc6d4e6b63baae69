"""docket: Spark-native operators for filing and submission analytics.

Every operator is a plain function over DataFrames; the work is declared
with the DataFrame/SQL API and left to Catalyst, AQE and Tungsten.
"""

__version__ = "0.1.0"
