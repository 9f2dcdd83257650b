"""DataFrame operators, one module per business area."""
