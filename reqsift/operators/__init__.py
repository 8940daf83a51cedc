"""DataFrame-to-DataFrame operators, and the sinks that store their results."""
