"""Whole queries: staging, star schema, loaders, dashboard figures, segments."""
