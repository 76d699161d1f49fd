"""Every operator and report as a named query over the given test tables."""
