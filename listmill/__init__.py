"""Spark-native toolkit for scraped listings: log -> bronze -> silver, plus URL bookkeeping."""
