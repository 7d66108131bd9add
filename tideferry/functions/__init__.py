"""Column helpers shared by the operators; each takes and returns Columns."""
