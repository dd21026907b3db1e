"""Reading and writing tables, feeds and run logs."""
