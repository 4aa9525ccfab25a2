"""lodestrata: a PySpark-native analytics engine for dated records, rankings and their evaluation."""
