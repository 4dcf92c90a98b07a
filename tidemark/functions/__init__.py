"""Column-level building blocks: text, type maps and casts."""
