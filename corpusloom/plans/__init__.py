"""Session set-up, shared-folder tables and the query registry."""
