"""Column builders: text, flags and geometry."""
