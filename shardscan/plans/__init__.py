"""Split planning: statistics -> ranges (Spark column form and Python integer form)."""
