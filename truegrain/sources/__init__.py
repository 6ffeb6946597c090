"""Reading and writing tables, files, contracts and histories."""
