"""gustloom: a Spark-first engine for point-forecast bundles and text corpora."""
