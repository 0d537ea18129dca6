"""Named queries: summary views, dashboard catalogue, panels, chart data."""
