"""Driver queries, one per operator, with their SQL twins."""

import workload.models  # noqa: F401
import workload.relational  # noqa: F401
import workload.scalar  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
