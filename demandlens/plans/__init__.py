"""Silver and gold models, the pipeline that builds them, and the registered queries."""
