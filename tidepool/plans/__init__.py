"""End-to-end plans over the driver tables."""
