"""turnloom: a Spark-native engine for dialogue and turn-taking corpora."""
