"""Point-in-time analytics over append-only observation data, on Spark."""
