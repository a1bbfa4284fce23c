"""Column-level helpers: each returns a ``Column`` built only from
built-in Spark SQL expressions, so they stay inside whole-stage codegen."""
