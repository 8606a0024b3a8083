"""granary: a Spark-native engine for building, auditing and packaging instruction-tuning corpora."""
