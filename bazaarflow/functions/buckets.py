"""CASE-style labels."""

from pyspark.sql import Column, functions as F

from .numeric import col


def sentiment_band(score: str | Column) -> Column:
    """Seller band shown with an average sentiment."""
    s = col(score)
    return F.when(s >= 0.7, "STRONG").when(s >= 0.4, "MIXED").otherwise("POOR")


def rating_sentiment(rating: str | Column) -> Column:
    """Sentiment taken from the stars when there is no model answer."""
    r = col(rating)
    return F.when(r >= 4, "POSITIVE").when(r <= 2, "NEGATIVE").otherwise("NEUTRAL")
