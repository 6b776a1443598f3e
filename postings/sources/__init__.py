"""Reading and writing snapshots and results."""
