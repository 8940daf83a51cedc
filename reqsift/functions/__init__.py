"""Column expressions: text framing, request parsing, redaction."""
