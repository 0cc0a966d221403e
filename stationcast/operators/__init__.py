"""DataFrame-to-DataFrame operators.  All are lazy."""
