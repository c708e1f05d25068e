"""Feature stages, models, tuning."""
