"""Table schemas, fixed-point numbers, time and exchange conventions."""
