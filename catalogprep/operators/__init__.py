"""DataFrame operators (all lazy; columns are parameters)."""
