"""DataFrame to DataFrame operators; none of them touches storage unless its docstring says so."""
