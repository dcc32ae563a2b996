"""Models, measures and dashboard queries, composed from functions and operators."""
