"""Column expressions shared by the reports; built-in functions only, no Python UDFs."""
