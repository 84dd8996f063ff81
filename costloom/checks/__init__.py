"""The operators on the shared test tables, each next to its SQL counterpart."""
