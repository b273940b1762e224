"""sources of daybook."""
