"""Layer flow, schema registry and catalog."""
