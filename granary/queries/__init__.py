"""Queries over the driver tables: every operator and every layer job."""

from granary.queries.layers import LAYER_QUERIES
from granary.queries.operators import OPERATOR_QUERIES

ALL_QUERIES = {**OPERATOR_QUERIES, **LAYER_QUERIES}
