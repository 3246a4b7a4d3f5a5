"""Frame-level operators: conforming, de-duplication, periods and quality checks."""
