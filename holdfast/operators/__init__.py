"""Fitted and relational operators over DataFrames."""
