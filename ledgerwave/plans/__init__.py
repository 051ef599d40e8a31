"""Compositions of operators: the revenue marts, the reports, the bout analytics."""
