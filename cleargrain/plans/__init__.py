"""Jobs built from the operators: staging, warehouse, analytics, reports."""
