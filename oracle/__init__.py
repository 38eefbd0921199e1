"""Plain SQL for checking the Spark reports; nothing in the library depends on it."""
