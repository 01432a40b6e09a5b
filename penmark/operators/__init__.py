"""DataFrame operators: metrics, terms, features, pages, ingest, models, evaluation."""
