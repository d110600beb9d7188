"""DataFrame operators: ingest, cleaning, quality, patient history, Gold tables and reports."""
