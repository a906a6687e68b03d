"""Data operators: gates, upserts, dimensions, facts, views, monitoring, audits."""
