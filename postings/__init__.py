"""Analytics over snapshots of classified postings, as plain Spark DataFrame functions."""
