"""Jobs composed of the operators, and the catalogue of registered queries."""
