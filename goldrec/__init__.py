"""Entity mastering on Spark: standardise, match, survive, publish, upsert, report."""
