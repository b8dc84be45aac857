"""Small column expressions shared by the operators."""

from tunesmith.functions.exact import all_of, any_null, any_of, money, null_safe, seconds_between, spread_hash, typed

__all__ = ["all_of", "any_null", "any_of", "money", "null_safe", "seconds_between", "spread_hash", "typed"]
