"""Market knowledge tables, graph questions and ranked retrieval as Spark DataFrames."""

__version__ = "0.1.0"
