"""Jobs: whole compositions of operators. Each function returns DataFrames; writing is a separate, explicit step."""
