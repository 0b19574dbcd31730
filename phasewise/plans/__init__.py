"""Study-level plans: compositions of the operators, one per result table."""
