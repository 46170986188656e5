"""plinth: a Spark-first engine that turns documents and a label catalogue into labelled, packed training data."""
