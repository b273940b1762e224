"""functions of daybook."""
