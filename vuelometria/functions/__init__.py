"""Column expressions shared by the models and the dashboard queries."""
