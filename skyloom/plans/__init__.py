"""Named, parameterised queries and the registered query set."""
