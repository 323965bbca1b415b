"""E-commerce event analytics written with the Spark DataFrame API."""
