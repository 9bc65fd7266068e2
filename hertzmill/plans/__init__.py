"""Join plans for half-open integer intervals."""
