"""loomline: a Spark-native analytics engine for spoken-word transcript corpora."""
