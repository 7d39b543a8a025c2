"""impactflow: measure the impact of published works from linked raw sources, on Spark."""
