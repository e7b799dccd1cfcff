"""Text operators for building training data, each one a Spark job over a table of documents."""
