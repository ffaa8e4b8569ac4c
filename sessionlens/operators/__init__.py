"""DataFrame operators, grouped by inventory section."""
