"""Input tables, recast views and file locations."""
