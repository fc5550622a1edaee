"""Column functions: identifiers, text clean-up, keys and scores."""
