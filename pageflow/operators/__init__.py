"""DataFrame to DataFrame functions, one module per topic."""
