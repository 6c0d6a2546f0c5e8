"""Every operator as a query over the given tables, with SQL for the same result."""
