"""File streams: bronze ingestion, landing loads and the change-fed upsert."""
