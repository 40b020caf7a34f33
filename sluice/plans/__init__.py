"""Whole plans: the record pipeline and the registered queries."""
