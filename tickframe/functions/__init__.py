"""Column-level helpers (all JVM-side built-ins, codegen friendly)."""

from .frames import bin_start, frames_to_seconds, minute_of  # noqa: F401
from .enums import code_to_name, name_to_code  # noqa: F401
from .numeric import euclid, quantize  # noqa: F401
from .frames_ops import force_int_column, null_counts, union_diagonal  # noqa: F401
