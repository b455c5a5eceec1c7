"""ledgerline: portfolio reporting on PySpark, expressed as DataFrame plans."""
