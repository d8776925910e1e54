"""DataFrame operators grouped by kind."""
