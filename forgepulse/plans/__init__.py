"""Models, reports and the full build: operators put together."""
