"""Feature graphs and trading plans, compiled to DataFrame transforms."""
