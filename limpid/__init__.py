"""limpid: Spark-native cleaning of administrative files into regional marts."""
