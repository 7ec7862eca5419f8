"""Column expressions shared by the operators; all native, none runs Python per row."""
