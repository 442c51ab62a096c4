"""Spark-native retail medallion: landing, bronze, silver, gold and the analyses over gold."""
