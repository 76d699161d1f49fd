"""Where tables are read from and results are written to."""
