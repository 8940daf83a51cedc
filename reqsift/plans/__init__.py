"""Step registry, the named queries and their SQL counterparts."""
