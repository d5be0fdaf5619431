"""Column expressions shared by the reports and rules."""
