"""tidemark: leak-free customer order analytics on Spark DataFrames."""

from tidemark.settings import SearchSpace, Settings

__all__ = ["SearchSpace", "Settings"]
