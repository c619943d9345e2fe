"""Operators for preparing training text; nothing else in ``mqtable`` imports them."""
