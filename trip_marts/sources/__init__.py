"""Reading and writing: files, catalog tables, published snapshots."""
