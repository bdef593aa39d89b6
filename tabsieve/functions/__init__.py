"""Column-expression helpers (scalar), the text-fold pandas UDF (textfold),
special functions as Column expressions (special) and distributed ranking."""
