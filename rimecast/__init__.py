"""rimecast: precipitation type diagnostics of weather-model columns on Spark."""

from .functions.constants import CODE_NAMES, TYPES
from .operators.diagnose import categorical, diagnose_levels
from .operators.kernel import categorical_arrays
from .operators.local import diagnose_column, diagnose_grid
from .plans.config import RunConfig
from .plans.monitoring import status as monitoring_status
from .plans.provenance import snapshot
from .plans.run import run

__all__ = ["CODE_NAMES", "TYPES", "RunConfig", "categorical", "categorical_arrays", "diagnose_column", "diagnose_grid", "diagnose_levels", "monitoring_status", "run", "snapshot"]
