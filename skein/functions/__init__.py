"""Column-level scalar functions (all Catalyst built-ins)."""
