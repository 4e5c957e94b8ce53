"""Message-log analytics on PySpark: extract, clean, assemble, export, profile."""
