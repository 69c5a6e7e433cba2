"""Column builders: everything stays an expression Catalyst can see."""
