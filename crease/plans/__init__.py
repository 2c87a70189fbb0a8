"""End-to-end plans: the batch pipeline and the SQL path."""
