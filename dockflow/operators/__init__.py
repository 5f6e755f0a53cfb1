"""DataFrame-to-DataFrame operators, grouped by concern."""
