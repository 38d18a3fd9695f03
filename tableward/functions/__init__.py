"""Column-level helpers: type classes, name rules and scalar expressions."""
