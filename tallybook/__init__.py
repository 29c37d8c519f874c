"""Financial statements from a double-entry journal, on PySpark."""
