"""Column-level functions of the change-data model."""
