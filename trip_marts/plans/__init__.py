"""Models built from the operators: staging, dimension, fact, marts, serving."""
