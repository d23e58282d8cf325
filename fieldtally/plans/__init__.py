"""Complete jobs assembled from the operators."""
