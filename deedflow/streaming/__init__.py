"""Rule-checked ingestion of a row stream."""
