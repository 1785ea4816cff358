"""passagemill: a Spark-native engine that turns passages into training and evaluation records."""
