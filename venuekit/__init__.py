"""venuekit: Spark-native analytics for places, their reviews and their activity."""

__version__ = "0.1.0"
