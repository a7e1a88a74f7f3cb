"""DataFrame to DataFrame operators on log lines and canonical events."""
