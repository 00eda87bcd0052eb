"""Column expressions: built-in functions only, so they stay in codegen."""
