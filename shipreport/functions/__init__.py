"""Column expressions with the text and date semantics the reports rely on."""
