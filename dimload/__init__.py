"""Loading and maintaining warehouse dimension tables with Spark."""
