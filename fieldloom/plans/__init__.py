"""Registered queries over the given tables, each with an equivalent SQL text."""

from . import encoding, linear, logistic, components, text

_MODULES = (text, encoding, linear, logistic, components)


def queries():
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracles():
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}


def flagship(spark, folder):
    return text.word_count_top10(spark, folder)
