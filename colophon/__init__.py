"""Colophon: a Spark-native engine for curated catalogues, result cells and paper pools."""
