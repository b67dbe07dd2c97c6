"""Event-feed analytics as Spark jobs: sources, cleaning, classification, idempotent loads, ledgers and reports."""
