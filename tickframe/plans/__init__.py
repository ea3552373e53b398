"""Plans: the user-facing stats, derived views, recipes and quality checks."""
