"""User-level queries: corpus scoring, recommendation, preference search, evaluation."""
