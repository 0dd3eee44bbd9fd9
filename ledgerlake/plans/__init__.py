"""Entity catalogue, layer wiring, the pipeline runner and the query registry."""
