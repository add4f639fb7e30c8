from .catalog import QUERIES, ORACLE_SQL, register  # noqa: F401
from . import batch  # noqa: F401  (registers the batch queries)
from . import streams  # noqa: F401  (registers the streaming twins)
