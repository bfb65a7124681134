"""DataFrame operators of the relevance job."""
