"""DataFrame building blocks; see the modules for the operators."""
