"""HTTP request-log analytics on Spark: parse, redact, sift by allowlist, count, archive."""
