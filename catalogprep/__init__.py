"""catalogprep — catalogue preparation and profiling on Spark DataFrames.

Every public function takes DataFrames (plus column names as parameters) and
returns a lazy DataFrame; the only actions are the caller's, except for small,
bounded size checks before a broadcast and explicit write helpers.
"""

__version__ = "0.1.0"
