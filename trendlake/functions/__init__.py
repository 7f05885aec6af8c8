"""Column expressions; each takes and returns a Column and stays inside generated code."""
