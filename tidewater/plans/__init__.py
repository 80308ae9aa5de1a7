"""Dashboard reports and the registered queries."""
