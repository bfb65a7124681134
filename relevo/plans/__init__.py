"""Jobs, registered queries and their oracles."""
