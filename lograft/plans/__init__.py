"""Named queries and end-to-end report jobs."""
