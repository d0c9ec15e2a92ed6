"""kinlink: record linkage and crosswalk building as lazy Spark DataFrame plans."""
