"""Column builders. Everything here stays in the JVM unless its docstring says otherwise."""
