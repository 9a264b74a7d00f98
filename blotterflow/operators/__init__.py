"""DataFrame operators; none of them runs a job when called."""
