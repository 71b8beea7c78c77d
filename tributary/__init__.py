"""Event analytics on Spark: declarative DataFrame / SQL operators."""
