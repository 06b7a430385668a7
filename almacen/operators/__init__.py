"""DataFrame operators: each takes lazy frames and returns lazy frames."""
