"""dimweave: warehouse loads (change feeds, history, publish, cleanup) as Spark DataFrames."""

from dimweave.spec import LoadSpec

__all__ = ["LoadSpec"]
