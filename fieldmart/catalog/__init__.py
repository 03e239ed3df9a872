"""Every operator and report on the benchmark tables, with equivalent SQL."""
