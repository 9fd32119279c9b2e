"""The library's operators bound to the given tables, with SQL for each."""
