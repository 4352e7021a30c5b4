"""playerledger: game-event ETL with keyed document tables, built on Spark DataFrames."""

__version__ = "0.1.0"
