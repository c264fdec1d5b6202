"""Model fitting, scoring and attribution on Spark."""
