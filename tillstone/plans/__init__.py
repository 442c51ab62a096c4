"""Layer builders (landing to gold), the calendar and the analytical queries."""
