"""DataFrame operators, independent of the survey's column names."""
