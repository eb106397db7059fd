"""Table-level operators: cleaning, enrichment, aggregation, reports, validators."""
