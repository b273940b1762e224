"""plans of daybook."""
