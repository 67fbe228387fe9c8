"""Reading sources, lake tables and their commit log."""
