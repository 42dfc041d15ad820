"""Jobs composed from the operators: ingest, silver, gold, reprocessing, QA."""
