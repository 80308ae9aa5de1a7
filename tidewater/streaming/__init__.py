"""The warehouse steps as continuously running queries."""
