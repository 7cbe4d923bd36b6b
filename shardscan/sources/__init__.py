"""Sources: shard discovery, probes and the two scan backends (Spark JDBC, Python DB-API)."""
