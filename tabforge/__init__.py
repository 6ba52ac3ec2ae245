"""tabforge: profiling, preparation, mining and modelling of tables on Spark DataFrames."""

__version__ = "0.1.0"
