"""DataFrame to DataFrame operators: lazy, no action inside unless stated."""
