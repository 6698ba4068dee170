"""Table operators: latest version, reject rules, global order, as-of, upsert, history, checks, security."""
