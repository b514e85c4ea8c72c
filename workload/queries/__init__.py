"""Importing this package registers all queries."""

from workload.queries import views  # noqa: F401
from workload.queries import messages  # noqa: F401
from workload.queries import ingest  # noqa: F401
from workload.queries import compliance  # noqa: F401
from workload.queries import metrics  # noqa: F401
from workload.queries import golden  # noqa: F401
from workload.queries import governance  # noqa: F401
from workload.queries import streams  # noqa: F401
