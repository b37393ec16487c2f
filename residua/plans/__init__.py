"""End-to-end jobs: fitting a detector, scoring, held-out evaluation, and the query catalogue."""
