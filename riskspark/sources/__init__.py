from riskspark.sources.derived import Workspace, table  # noqa: F401
from riskspark.sources.readers import extract, get_source, register_source  # noqa: F401
