"""Column-level building blocks: every function here returns a Column."""
