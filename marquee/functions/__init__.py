"""Column expressions: lenient parsing, fixed lookups and id helpers."""
