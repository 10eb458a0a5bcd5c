"""Sales and revenue analytics as Spark jobs.

Every operator is a function from DataFrames and a parameter object to a
DataFrame.  Nothing here holds state or runs an action unless its name says so
(``enforce_*``, ``write_*``).
"""

__version__ = "0.1.0"
