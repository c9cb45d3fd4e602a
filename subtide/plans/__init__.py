"""Models, reports and data checks."""
