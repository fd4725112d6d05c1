from .types import CAST_TYPES, cast_type, type_kind  # noqa: F401
from .naming import renamed, rename_map, target_name  # noqa: F401
from . import exprs  # noqa: F401
