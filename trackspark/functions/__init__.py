"""Column helpers: everything here is a Column expression evaluated by Spark."""
