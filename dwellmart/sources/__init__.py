"""Where data comes from and goes to: landing zone, curated zone, warehouse tables."""
