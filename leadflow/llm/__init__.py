"""Operators of a training-data pipeline, each a module; ``queries`` registers
one query per operator.  Nothing outside this package imports it, except the
driver entry point, which does without it if it is absent."""
