"""terrasift: a PySpark-native engine for geospatial candidate screening."""
