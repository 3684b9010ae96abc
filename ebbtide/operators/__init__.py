"""DataFrame operators of the three layers, the checks and the reports."""
