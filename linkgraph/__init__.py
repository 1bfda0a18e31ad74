"""linkgraph: turn flat or nested tables into property graphs with Spark DataFrames."""

__version__ = "0.1.0"
