"""Configured plans: scorecards, the medallion flow, the query catalog."""
