"""Column builders: no I/O, no Python UDFs, everything stays inside generated code."""
