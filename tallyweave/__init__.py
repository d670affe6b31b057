"""Record linkage and analytics on Spark: declarative plans, few Arrow functions."""
