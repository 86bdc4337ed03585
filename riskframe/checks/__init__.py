"""Registered queries over the policy view, each with its SQL twin where SQL can say it.

A module holds two dictionaries: QUERIES maps a name to ``f(spark, sf_dir)``, and SQL maps
the same name to a statement over the star-schema tables.
"""

from riskframe.checks import features, hypotheses, kpis, modelling, profiles, quality

MODULES = [quality, kpis, profiles, features, hypotheses, modelling]

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
