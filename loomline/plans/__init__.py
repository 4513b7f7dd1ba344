"""Tables and reports composed from the operators."""
