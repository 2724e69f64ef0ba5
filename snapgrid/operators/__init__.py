"""DataFrame operators. Key, time and state columns are always arguments."""
