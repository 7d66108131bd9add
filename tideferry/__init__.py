"""Move tables between systems on Spark, and prove that the move was right."""

__version__ = "0.1.0"
