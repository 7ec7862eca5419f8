"""Vehicle-trip and credit-ledger analytics on Spark DataFrames."""

from fleetledger.params import ParamSet, Range, SourceParams, SplitRule
from fleetledger.session import configure

__all__ = ["ParamSet", "Range", "SourceParams", "SplitRule", "configure"]
