"""Writers."""
