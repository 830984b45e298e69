"""DataFrame -> DataFrame operators; each one is lazy apart from the bounded skew checks."""
