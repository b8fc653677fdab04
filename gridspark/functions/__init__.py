"""Column-level functions: scalar cleaning rules and geometry."""
