"""DataFrame operators of the matching and link cascade."""
