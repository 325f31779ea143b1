"""quoin: entity matching, similarity retrieval and scoring on PySpark DataFrames."""

__version__ = "0.1.0"
