"""Change-log analytics on PySpark: raw CDC tables to typed tables, marts and audits."""
