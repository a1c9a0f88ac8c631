"""Plans: core tables and the reports on them."""
