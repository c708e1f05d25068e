"""Jobs, and the queries this repository registers."""
