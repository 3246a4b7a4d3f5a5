"""The operators bound to the test tables, with the equivalent SQL for an independent engine."""
