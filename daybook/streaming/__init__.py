"""streaming of daybook."""
