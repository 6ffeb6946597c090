"""Column-level building blocks: cell tests and the row-rule language."""
