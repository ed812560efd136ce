"""Campaign-response analytics as plain DataFrame-to-DataFrame operators on Spark."""
