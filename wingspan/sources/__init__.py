from wingspan.sources.driver import DRIVER_TABLES, read_table  # noqa: F401
from wingspan.sources.bindings import BINDINGS, bound, oracle_prelude  # noqa: F401
