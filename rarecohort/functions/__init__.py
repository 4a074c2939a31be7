"""Column expressions: no function in here moves or groups rows."""
