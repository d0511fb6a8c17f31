"""Jobs made of operators, from landed files to loaded tables."""
