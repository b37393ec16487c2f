"""Table-to-table operators: labels, splits, repair, profiling, scoring, evaluation, explanation."""
