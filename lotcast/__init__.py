"""lotcast: Spark-native cleaning, reporting, model training and scoring
for auction listings, in batch and on streams."""

__version__ = "0.1.0"
