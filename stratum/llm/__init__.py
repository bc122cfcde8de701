"""Training-data operators: one module per operator, queries in ``catalog``.

Nothing outside this package imports it; it may be deleted as a whole.

Operators keep all columns of their input, whatever they are called; names that
begin with an underscore are the operators' own.
"""
