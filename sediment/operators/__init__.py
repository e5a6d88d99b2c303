"""DataFrame operators: frame in, frame out, nothing collected unless its size is bounded."""
