"""Plans: tag catalogue fixtures, stand-in business frames over the test
tables, the run-a-tag template and the registered query set."""
