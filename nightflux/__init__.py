"""nightflux: time-series photometry of the night sky as Spark DataFrame operators.

Everything takes DataFrames and returns DataFrames.  Groups are named by explicit
key columns, so many targets, filters, nights and apertures run in one plan.
"""

__version__ = "0.1.0"
