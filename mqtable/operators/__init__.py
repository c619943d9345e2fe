"""Queue operators: pure ``DataFrame -> DataFrame`` transformations."""
