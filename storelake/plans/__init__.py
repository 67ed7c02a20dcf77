"""Models and questions composed from the operators."""
