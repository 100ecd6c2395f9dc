"""The queries over the test tables, each with its SQL twin."""

from .plans.audit import A
from .plans.evaluation import V
from .plans.gates import K
from .plans.labels import R
from .plans.market import M

_ALL = (M, R, A, V, K)
QUERIES = {name: f for registry in _ALL for name, f in registry.queries.items()}
ORACLE_SQL = {name: sql for registry in _ALL for name, sql in registry.sql.items()}
