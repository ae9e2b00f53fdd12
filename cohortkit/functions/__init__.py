"""Column expressions with the reference's semantics (dates, integer arithmetic, keyed values)."""
