"""Column functions. All are built-in expressions and stay inside codegen."""
