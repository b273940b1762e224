"""operators of daybook."""
