"""Column expressions. Nothing in this package touches a DataFrame or starts a job."""
