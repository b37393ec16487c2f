"""Reading logs and tables, numbering records, writing results and fitted models."""
