"""DuckDB SQL counterparts of the registered queries."""

from oracles.layers import LAYER_ORACLES
from oracles.operators import OPERATOR_ORACLES

ALL_ORACLES = {**OPERATOR_ORACLES, **LAYER_ORACLES}
