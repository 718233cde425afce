"""citeloom: a Spark-native citation-graph and document analytics engine."""
