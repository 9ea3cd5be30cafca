"""Writers for tickets, marts and the dashboard payload."""
