"""DataFrame to DataFrame operators.

All take events as described by ``trolley.schemas.EVENT`` or the result of
another operator, are lazy, and work on all days of their input at once.
"""
