"""DataFrame -> DataFrame operators: cleaning, dimensions, enrichment, quality."""
