"""DataFrame operators: flatten, reduce to newest, merge, join, check."""
