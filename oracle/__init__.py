"""SQL counterparts of the queries, used only to check results."""
