"""docpipe: from semi-structured documents to clean, analysable tables on Spark."""
