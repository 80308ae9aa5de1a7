"""Tidewater: a layered retail warehouse written as Spark DataFrame transforms."""
