"""Column expressions: Column in, Column out, no DataFrame and no session."""
