"""DataFrame -> DataFrame operators; lazy unless the docstring says otherwise."""
