"""corpusloom: a Spark-native engine for building, curating, auditing and evaluating training corpora."""
