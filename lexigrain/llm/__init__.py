"""Operators for preparing training text from lexicon records, glosses and page markup."""
