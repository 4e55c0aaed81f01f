"""Spark jobs over revisioned monthly trade panels.

Every public function takes DataFrames (plus a frozen :class:`Params`) and gives
back a DataFrame, so a plan stays lazy until the caller writes or counts it.
"""

from monthloom.params import Params

__all__ = ["Params"]
