"""File actions: plans as DataFrames, and their one-time execution."""
