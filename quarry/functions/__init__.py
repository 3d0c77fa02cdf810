"""Column-expression builders: text parsing, JSON, colour spaces, statistics."""
