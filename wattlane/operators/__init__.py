"""Table-to-table DataFrame transforms."""
