"""Column expressions: per-row rules that stay inside code generation."""
