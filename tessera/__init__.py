"""tessera: evidence-style analytics on PySpark DataFrames.

Operators take and return DataFrames, are generic over column names, and keep
all planning declarative so that Catalyst and adaptive execution choose the
physical strategy.
"""

__version__ = "0.1.0"
