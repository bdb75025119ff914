"""Plans: the suite runner and the registered scenarios."""
