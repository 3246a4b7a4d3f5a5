"""Column builders: labels from code books, typed codes, and aggregate metrics."""
