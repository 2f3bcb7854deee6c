"""Operations on training text and vectors; nothing outside this subpackage imports it."""
