"""DataFrame operators; every one takes its column names as parameters."""
