"""A Spark-native engine that scores outputs of language models and agents."""
