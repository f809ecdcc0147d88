"""Evidence-checked text and route analytics on Spark."""
