"""tillroll: retail ELT and data-quality operators on Spark DataFrames.

Every public operator is a function from DataFrames (plus plain Python
parameters) to a DataFrame, so Catalyst sees one declarative plan per job.
"""

__version__ = "0.1.0"
