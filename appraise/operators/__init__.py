"""Table operators: each is a ``DataFrame -> DataFrame`` function built from DataFrame/SQL expressions."""
