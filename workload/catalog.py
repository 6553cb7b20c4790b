"""All registered queries."""

from workload import q_cells, q_loads, q_reports, q_runs, q_scalars, q_texts  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
