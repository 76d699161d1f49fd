"""The reports, composed of operators."""
